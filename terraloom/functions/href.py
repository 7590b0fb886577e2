"""Catalogue paths, urls and keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Patterns that decide the year and resolution columns.
YEAR_RANGE = r"_(\d{4}(?:-\d{4})?)(?=_)"
GSD = r"_(\d+\.?\d*m)(?=/|$)"

def clean_path(href: Column) -> Column:
    """Drop every ``./`` and the ``/collection.json`` tail."""
    return F.replace(
        F.replace(href, F.lit("./"), F.lit("")), F.lit("/collection.json"), F.lit("")
    )


def spaced(part: Column) -> Column:
    return F.replace(part, F.lit("-"), F.lit(" "))


def plain_number(value: Column) -> Column:
    """A double as text without an exponent, always with a decimal part."""
    short = value.cast("string")
    digits = F.regexp_replace(value.cast("decimal(38,12)").cast("string"), "0+$", "")
    return F.when(
        short.contains("E"), F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    ).otherwise(short)


def s3_url(bucket: Column, key: Column) -> Column:
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), key)


def https_url(bucket: Column, region: Column, key: Column) -> Column:
    return F.concat(
        F.lit("https://"), bucket, F.lit(".s3."), region, F.lit(".amazonaws.com/"), key
    )


def stages(href: Column, bucket: str | Column, region: str | Column) -> list[dict[str, Column]]:
    """All path derived columns of one collection href, as successive projections.

    Later stages use the columns of earlier ones, so no pattern or split is
    evaluated twice; columns starting with ``_`` are to be dropped at the end.
    Missing values are empty strings.  A path with fewer than three parts keeps
    its whole text as ``path`` and has no type, crs, year or resolution.
    """
    bucket = F.lit(bucket) if isinstance(bucket, str) else bucket
    region = F.lit(region) if isinstance(region, str) else region
    c, empty = F.col, F.lit("")
    inner = F.slice("_parts", 1, F.greatest(F.size("_parts") - 2, F.lit(0)))
    metres = F.regexp_extract("gsd", r"(\d+\.?\d*)m", 1).try_cast("double")
    return [
        {"_whole": clean_path(href)},
        {"_parts": F.split("_whole", "/")},
        {"_full": F.size("_parts") >= 3},
        {
            "path": F.when(c("_full"), F.array_join(inner, "/")).otherwise(c("_whole")),
            "region": spaced(F.get("_parts", F.lit(0))),
            "sub_region": spaced(F.substring_index(F.coalesce(F.get("_parts", F.lit(1)), empty), "_", 1)),
            "type": F.when(c("_full"), F.element_at("_parts", -2)).otherwise(empty),
            "crs": F.when(c("_full"), F.element_at("_parts", -1)).otherwise(empty),
            "s3": s3_url(bucket, F.concat("_whole", F.lit("/"))),
            "https": https_url(bucket, region, F.concat("_whole", F.lit("/"))),
        },
        {
            "year_range": F.when(c("_full"), F.regexp_extract("path", YEAR_RANGE, 1)).otherwise(empty),
            "gsd": F.when(c("_full"), F.regexp_extract("path", GSD, 1)).otherwise(empty),
        },
        {
            "base_year": F.substring_index("year_range", "-", 1),
            "_cm": metres * 100,
        },
        {"cellsize_cm": F.coalesce(plain_number(c("_cm")), empty)},
    ]


# Fixed value: the generic split of an url (RFC 3986, appendix B), path captured.
URL_PATH = r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)"


def url_key(url: Column) -> Column:
    """The path of an url without leading slashes; text after ``;`` is no path."""
    path = F.regexp_replace(F.regexp_extract(url, URL_PATH, 1), ";[^/]*$", "")
    return F.ltrim(path, F.lit("/"))


def collection_url(href: Column, base: str | Column) -> Column:
    """Full url of a collection; ``base`` ends without a slash."""
    base = F.lit(base) if isinstance(base, str) else base
    return F.when(
        href.startswith("./"),
        F.concat(base, F.lit("/"), F.replace(href, F.lit("./"), F.lit(""))),
    ).otherwise(href)


def folder_of(key: Column) -> Column:
    """Everything before the last slash (empty without one)."""
    return F.when(key.contains("/"), F.regexp_replace(key, "/[^/]*$", "")).otherwise("")


def item_key(item_href: Column, collection_key: Column) -> Column:
    """Object key of an item link, resolved against its collection.

    Every ``./`` inside a relative link is replaced by the folder, not only the
    leading one.
    """
    folder = folder_of(collection_key)
    return (
        F.when(
            item_href.startswith("./"),
            F.replace(item_href, F.lit("./"), F.concat(folder, F.lit("/"))),
        )
        .when(item_href.startswith("http"), url_key(item_href))
        .otherwise(F.concat(folder, F.lit("/"), item_href))
    )


def base_name(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def as_folder(prefix: Column) -> Column:
    """A prefix with its trailing slash."""
    return F.when(prefix.endswith("/"), prefix).otherwise(F.concat(prefix, F.lit("/")))


def has_suffix(key: Column, suffixes) -> Column:
    """Case-insensitive test against several extensions."""
    found = F.lit(False)
    for suffix in suffixes:
        found = found | F.lower(key).endswith(suffix.lower())
    return found


def list_text(values: Column) -> Column:
    """``[a, b, c]``; an absent list gives ``[]``."""
    return F.concat(
        F.lit("["), F.coalesce(F.array_join(values.cast("array<string>"), ", "), F.lit("")), F.lit("]")
    )
