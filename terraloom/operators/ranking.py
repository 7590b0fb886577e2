"""Exact row numbers without one task per group."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window, functions as F

from terraloom.session import shared_folder

#: Rows of a piece, about.
PIECE_ROWS = 500_000


def row_numbers(df: DataFrame, group: str, order: list[str], out: str = "i", total: str = "n",
                pieces: int | None = None) -> DataFrame:
    """Add ``i`` (1-based, by ``order``) and ``n`` within each group; null groups are a group.

    ``order`` must be unique inside a group.  Rows are range-partitioned by
    group and order into as many pieces as their number asks for (or
    ``pieces``), numbered inside a piece as they are written, and the sizes of
    the group's earlier pieces are added.  The cut points decide the balance,
    never the numbers, so a hot group is spread and stays exact.
    """
    if pieces is None:
        pieces = max(1, -(-df.count() // PIECE_ROWS))
    spark = df.sparkSession
    ranged = df.repartitionByRange(pieces, group, *order).withColumn("_piece", F.spark_partition_id())
    # The pieces are written once: sampling again might cut elsewhere.
    path = f"{shared_folder(spark)}/pieces-{uuid.uuid4().hex}"
    ranged.write.parquet(path)
    cut = spark.read.schema(ranged.schema).parquet(path)
    # At most one row per group and piece.
    sizes = cut.groupBy(group, "_piece").agg(F.count(F.lit(1)).alias("_m"))
    before = Window.partitionBy(group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(group).alias("_group"), F.col("_piece").alias("_of"),
        F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_skip"),
        F.sum("_m").over(Window.partitionBy(group)).alias(total),
    )
    inside = Window.partitionBy(group, "_piece").orderBy(*order)
    numbered = cut.withColumn("_i", F.row_number().over(inside))
    return (
        numbered.join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_piece") == F.col("_of")))
        .withColumn(out, F.col("_i") + F.col("_skip"))
        .drop("_i", "_piece", "_skip", "_group", "_of")
    )
