"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from terraloom.session import shared_folder

# The separators of words in the contracts.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts the lineage: rows, and columns made by tasks, are the same for every
    later reader, whichever executors are lost.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(text: str | Column) -> Column:
    """UTF-8 length of a text, 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def bytes_of(docs: DataFrame, text: str) -> int:
    """UTF-8 bytes of a whole text column, by one job."""
    return docs.agg(F.coalesce(F.sum(text_bytes(text)), F.lit(0)).alias("n")).first()["n"]


def unit(*cols: str | Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the columns only, not on the run."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11)).cast("double") / F.lit(float(1 << 53))


def listed(table, name: str) -> list:
    """A column of one side of a cogroup as a list; that side has no columns where it has no rows."""
    return table.column(name).to_pylist() if table.num_rows else []


def sealed(docs: DataFrame):
    """``docs`` with columns c0, c1, ..., their new names by the old ones, and a function that gives the old names back.

    Work between the two may add columns of any name that begins with an
    underscore: none of the input can have it.
    """
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])

    def back(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])

    return inner, dict(zip(names, inner.columns)), back


def unclashing(columns, added) -> None:
    """Raise where an operator would have to return two columns of one name."""
    both = sorted(set(columns) & set(added))
    if both:
        raise ValueError(f"columns {both} have the names of results; rename them first")
