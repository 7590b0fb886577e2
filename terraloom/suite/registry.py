"""Where queries register."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terraloom.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``, with its oracle where SQL can express it."""

    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @functools.wraps(fn)
        def run(spark, sf):
            ship(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def six(value: str | Column) -> Column:
    """Doubles are compared at six digits."""
    return F.round(F.col(value) if isinstance(value, str) else value, 6)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: six(n) for n in names})
