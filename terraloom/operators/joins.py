"""Joins that stay healthy when one side is tiny or one key is hot."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from terraloom.session import shared_folder

# A side is broadcast only when both bounds hold, checked by an action.
BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 64 * 1024 * 1024

# A key counts as hot from ``min_rows`` on, and never below this share of the
# rows, so the table of hot keys fits a broadcast whatever the data.
HOT_SHARE = 1 / BROADCAST_ROWS


def is_small(df: DataFrame) -> bool:
    """True when the frame provably fits a broadcast; runs one bounded job."""
    width = F.length(F.to_json(F.struct("*")))
    seen = (
        df.limit(BROADCAST_ROWS + 1)
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("chars"))
        .first()
    )
    return seen["n"] <= BROADCAST_ROWS and seen["chars"] <= BROADCAST_CHARS


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written below the shared folder and read back, so that no later job works it out again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_keys(df: DataFrame, keys: list[str], min_rows: int = 100_000) -> DataFrame:
    """Keys with ``min_rows`` rows and more than ``HOT_SHARE`` of all, with a split count.

    Counted once, by one job that leaves the few keys in the shared folder.  At
    most ``1 / HOT_SHARE`` rows, so the result may be broadcast.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = stored(counts.filter(F.col("_n") >= min_rows), "hot")
    if hot.count() > 1 / HOT_SHARE:  # only then the total decides
        hot = hot.filter(F.col("_n") > df.count() * HOT_SHARE)
    return hot.select(*keys, F.ceil(F.col("_n") / min_rows).cast("int").alias("_splits"))


def _salted(df: DataFrame, hot: DataFrame | None, keys: list[str], spread: Column, name: str) -> DataFrame:
    """Give each row of a hot key one of that key's salts, every other row salt 0."""
    missing = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    if hot is None:
        return df.withColumn(name, F.when(missing, F.pmod(F.xxhash64(spread), F.lit(1000))).otherwise(0).cast("int"))
    splits = F.when(missing, F.lit(1000)).otherwise(F.col("_splits"))
    return df.join(hot, keys, "left").withColumn(
        name, F.coalesce(F.pmod(F.xxhash64(spread), splits), F.lit(0)).cast("int")
    ).drop("_splits")


def _repeated(df: DataFrame, hot: DataFrame | None, keys: list[str], name: str) -> DataFrame:
    """Repeat each row once per salt of its key."""
    if hot is None:
        return df.withColumn(name, F.lit(0))
    salts = F.sequence(F.lit(0), F.coalesce(F.col("_splits"), F.lit(1)) - 1)
    return df.join(hot, keys, "left").withColumn(name, F.explode(salts)).drop("_splits")


def _hot(df: DataFrame, keys: list[str], min_rows: int) -> DataFrame | None:
    """Hot keys ready to be broadcast, or None where there are none: the plan then has no joins for them."""
    hot = hot_keys(df, keys, min_rows)
    return None if hot.isEmpty() else F.broadcast(hot)


def split_hot(left: DataFrame, right: DataFrame, keys: list[str], left_spread: Column,
              right_spread: Column | None = None,
              min_rows: int = 100_000) -> tuple[DataFrame, DataFrame, list[str]]:
    """Salt both sides of an equi-join on the hot keys of the left side.

    A hot key's left rows are spread over several salts by the hash of
    ``left_spread``, which must tell rows of one key apart (an id); its right
    rows are repeated once per salt.  With ``right_spread`` hot keys of the
    right side are treated likewise.  Rows with a null key match nothing and
    are spread as well.  Join on the returned keys and drop ``_salt`` and
    ``_salt2``; the result equals the plain join.
    """
    hot = _hot(left, keys, min_rows)
    salted, on = _salted(left, hot, keys, left_spread, "_salt"), [*keys, "_salt"]
    repeated = _repeated(right, hot, keys, "_salt")
    if right_spread is not None:
        hot = _hot(right, keys, min_rows)
        repeated = _salted(repeated, hot, keys, right_spread, "_salt2")
        salted, on = _repeated(salted, hot, keys, "_salt2"), [*on, "_salt2"]
    return salted, repeated, on


def lookup(big: DataFrame, small: DataFrame, keys: list[str], how: str = "left",
           spread: Column | None = None) -> DataFrame:
    """Join ``big`` to a keyed side table.

    The side table is worked out once, into the shared folder, and broadcast
    when ``is_small`` proves that it fits; otherwise hot keys of the big side are
    salted and Spark picks the join.  ``spread`` must differ between rows of one
    key (all columns by default).
    """
    small = stored(small, "side")
    if is_small(small):
        return big.join(F.broadcast(small), keys, how)
    spread = F.struct(*big.columns) if spread is None else spread
    left, right, on = split_hot(big, small, keys, spread)
    return left.join(right, on, how).drop("_salt")
