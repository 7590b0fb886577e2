"""A content-addressed WARC archive.

Payload bytes are stored once under their SHA-256, which is verified on the way
in and on the way out; the exact header block of every record is kept in a
table of its own.  The original records are header, payload and end marker, put
together again by a join on the digest.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terraloom.session import shared_folder

# Fixed values of the formats.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: eight groups of five hex digits give four letters each."""
    digest = F.sha1(payload)
    letters = []
    for group in range(8):
        value = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substring(F.lit(BASE32), place, F.lit(1)))
    return F.concat(*letters)


def _line(name: str, value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))


def staged(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One numbered record per page with its payload's digests but not the payload, written under ``folder``."""
    record = (
        pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), _payload(html).alias("payload"))
        .withColumns({
            "record_no": F.monotonically_increasing_id(),
            "payload_bytes": F.octet_length("payload").cast("long"),
            "content_key": F.sha2("payload", 256),
            "payload_digest": base32_sha1(F.col("payload")),
        })
    )
    return _table(record.drop("payload"), f"{folder}/staged")


def _payload(html: str) -> Column:
    return F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")


def _table(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", page_id: str = "page_id",
          url: str = "url", html: str = "html") -> None:
    """Archive every row of ``pages`` below ``folder``: tables ``payloads`` and ``headers``.

    Of records with equal payloads of at least ``min_bytes`` the first by
    (page_id, nulls last, input order) is the response and the others are
    revisits that refer to it; smaller payloads are responses all.  Null html
    is an empty payload, a null url leaves its header line out, repeated rows
    are records of their own, and extra columns are not archived.
    """
    records = staged(pages, folder, page_id, url, html)
    order = F.struct(F.col("page_id").isNull().alias("_null"), "page_id", "record_no")
    first = records.groupBy("content_key").agg(F.min(order).alias("_first"))
    # Copies within a task become one row before any payload moves.
    payloads = pages.select(_payload(html).alias("payload")).withColumn("content_key", F.sha2("payload", 256)).dropDuplicates(["content_key"])
    # The stored bytes are read back: a key that is not theirs, or one that is missing, ends the job.
    stored = _table(payloads, f"{folder}/payloads").select(
        F.count(F.lit(1)).alias("n"), F.count_if(F.sha2("payload", 256) != F.col("content_key")).alias("wrong")).first()
    if stored["wrong"] or stored["n"] != first.count():
        raise RuntimeError(f"{folder}: stored payloads do not have their digests")

    slim = records.join(first, "content_key")
    revisit = (F.col("payload_bytes") >= min_bytes) & (F.col("record_no") != F.col("_first.record_no"))

    def urn(page: Column, number: Column) -> Column:
        return F.concat(F.lit("<urn:x-page:"), F.coalesce(page.cast("string"), F.concat(F.lit("none-"), number)), F.lit(":"), number, F.lit(">"))

    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", urn(F.col("page_id"), F.col("record_no"))),
        _line("WARC-Target-URI", F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")),
        _line("WARC-Date", date),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        F.when(revisit, F.concat(
            _line("WARC-Refers-To", urn(F.col("_first.page_id"), F.col("_first.record_no"))),
            _line("WARC-Profile", SAME_PAYLOAD))).otherwise(F.lit("")),
        _line("Content-Type", "text/html"),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string")),
        F.lit("\r\n"),
    )
    _table(slim.select("record_no", "page_id", F.encode(header, "UTF-8").alias("header"), "content_key"), f"{folder}/headers")


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record as it was: record_no, record (its exact bytes), payload (the full one, also for revisits).

    A group of copies may be large; its headers join one payload row, and
    adaptive execution splits the headers of a hot payload over several tasks.
    """
    headers = spark.read.parquet(f"{folder}/headers")
    payloads = spark.read.parquet(f"{folder}/payloads").withColumn("_verified", F.sha2("payload", 256) == F.col("content_key"))
    own = F.when(F.contains(F.decode("header", "UTF-8"), F.lit("\r\nWARC-Type: revisit\r\n")), F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload"))
    return headers.join(payloads, "content_key").select(
        "record_no", "page_id", F.concat(F.col("header"), own, F.encode(F.lit(END), "UTF-8")).alias("record"), "payload",
        F.octet_length("header").alias("_header_bytes"), "_verified")


def parsed(records: DataFrame) -> DataFrame:
    """Fields read from the record bytes: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    block = F.substring(F.col("record"), F.lit(1), F.col("_header_bytes"))
    df = records.select("page_id", "payload", "_verified", F.decode(block, "UTF-8").alias("_head"))

    def field(name: str) -> Column:
        return F.regexp_extract("_head", f"\r\n{name}: ([^\r]*)\r\n", 1)

    refers = F.regexp_extract(field("WARC-Refers-To"), "<urn:x-page:(-?[0-9]+):", 1)
    return df.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.regexp_extract(field("WARC-Payload-Digest"), "sha1:(.*)", 1).alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        F.when(refers != "", refers.cast("long")).alias("refers_to"),
        (F.col("_verified") & (base32_sha1(F.col("payload")) == F.regexp_extract(field("WARC-Payload-Digest"), "sha1:(.*)", 1))).alias("verified"),
    )


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}"
