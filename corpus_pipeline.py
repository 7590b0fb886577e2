"""A pipeline of training-data stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.llm import mixing, packing, partenum, phrases, quality
from terraloom.llm.common import saved
from terraloom.llm.queries import tokenizer
from terraloom.session import ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs."""
    return quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each group of near-duplicates."""
    ship(spark)
    return partenum.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 50-byte strings that smaller ids have; n_chars follows the text."""
    ship(spark)
    return phrases.cleaned(docs, 50).withColumn("n_chars", F.length("text").cast("long"))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and those of small sources again, up to 1.25 times as a source."""
    return mixing.repeated(docs, max_repeats=1.25)


def token_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All tokens in sequences of 4096; a repeated document is packed once for each time."""
    ship(spark)
    return packing.packed(docs, tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mixture", source_mixture),
    ("token_packing", token_packing),
]

#: Several stages have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
