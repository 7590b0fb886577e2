"""Mixing sources to target weights by temperature.

Source weights are token shares to the power of an exponent between 0 and 1,
found by bisection: the smallest one whose weights still repeat no source more
than a limit, or the one whose weights have a target entropy.  The weights
become token budgets.  A source's documents lie in hashed blocks; each epoch
goes through all of them in a permutation of its own, and the last, partial
epoch takes blocks and finally documents in that order until the budget is
met.  Every block has a place between 0 and 1 in its source's schedule, so the
whole mixture sorted by place has the target weights all along.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from terraloom.llm.common import saved, sealed, unclashing, unit
from terraloom.operators.joins import is_small

BLOCK_TOKENS = 1 << 20
ADDED = ("_source", "_tokens", "_u", "_block", "_name", "_blocks", "_often", "_budget", "_number", "_epoch", "_place", "_upto")


def token_count(text: str) -> Column:
    """Words and an end mark, so that every document has a size."""
    return (F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")) + 1).cast("long")


def weights(tokens: list[int], exponent: float) -> list[float]:
    total = sum(tokens)
    raw = [(t / total) ** exponent if t else 0.0 for t in tokens]
    return [r / sum(raw) for r in raw]


def entropy(w: list[float]) -> float:
    return -sum(x * math.log(x) for x in w if x > 0)


def bisected(ok, rounds: int = 60) -> float:
    """Least exponent in [0, 1] with ``ok``, which holds above some point (at 1 at least)."""
    if ok(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(rounds):
        middle = (low + high) / 2
        low, high = (low, middle) if ok(middle) else (middle, high)
    return high


def repeats(tokens: list[int], max_repeats: float | None = None, target_entropy: float | None = None, budget: int | None = None) -> tuple[float, list[float]]:
    """The exponent, and how often each source is gone through.

    Without a budget every document is used at least once: the largest budget
    share decides.  With ``max_repeats`` the flattest mixture within the limit is
    taken, with ``target_entropy`` (nats) the one that has it, or the nearest.
    """
    def often(exponent: float) -> list[float]:
        w = weights(tokens, exponent)
        whole = budget if budget is not None else max((t / x for t, x in zip(tokens, w) if x > 0), default=0)
        return [x * whole / t if t else 0.0 for t, x in zip(tokens, w)]

    if not sum(tokens):
        return 1.0, [0.0] * len(tokens)
    if target_entropy is not None:
        # Entropy falls as the exponent grows.
        exponent = bisected(lambda e: e >= 1 or entropy(weights(tokens, e)) <= target_entropy)
    else:
        exponent = bisected(lambda e: e >= 1 or max(often(e)) <= max_repeats * (1 + 1e-12))
    # Whole numbers of epochs stay whole.
    return exponent, [float(round(x)) if abs(x - round(x)) < 1e-9 else x for x in often(exponent)]


def schedule(docs: DataFrame, source: str, doc_id: str, tokens: Column, max_repeats: float | None, target_entropy: float | None,
             budget: int | None, block_tokens: int) -> tuple[DataFrame, DataFrame]:
    """Documents with ``_source``, ``_tokens``, ``_block`` and ``_u``; and the blocks of every epoch:
    _source, _block, _epoch, _place, _upto (the last ``_u`` that the budget takes).

    One number per source meets on the driver.
    """
    spark = docs.sparkSession
    tagged = docs.withColumns({"_source": F.col(f"`{source}`").cast("string"), "_tokens": tokens})
    sums = tagged.groupBy("_source").agg(F.sum("_tokens").alias("t")).orderBy("_source").collect()
    exponent, often = repeats([r["t"] for r in sums], max_repeats, target_entropy, budget)
    shares = spark.createDataFrame(
        [(r["_source"], max(1, math.ceil(r["t"] / block_tokens)), float(o), float(o * r["t"])) for r, o in zip(sums, often)],
        "_source string, _blocks int, _often double, _budget double")
    named = shares.withColumnRenamed("_source", "_name")
    row = unit(F.col(f"`{doc_id}`"), "_tokens", seed=3)
    placed = tagged.join(named, F.col("_source").eqNullSafe(F.col("_name")), "left").withColumns({
        "_u": row, "_block": F.floor(unit(F.col(f"`{doc_id}`"), seed=31) * F.col("_blocks")).cast("int")}).drop("_name", "_blocks", "_often", "_budget")
    blocks = placed.groupBy("_source", "_block").agg(F.sum("_tokens").alias("_size"))
    epochs = (
        blocks.join(named, F.col("_source").eqNullSafe(F.col("_name")))
        .withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil("_often").cast("int") - 1, F.lit(0)))))
        .filter("_often > 0")
    )
    # A source's blocks in one window: small rows, one for each million tokens.
    order = Window.partitionBy("_source", "_epoch").orderBy(F.xxhash64("_source", "_epoch", "_block"), "_block")
    before = F.coalesce(F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum("_size").over(Window.partitionBy("_source", "_epoch"))
    epochs = epochs.withColumns({"_before": before, "_whole": whole})
    room = F.col("_budget") - F.col("_epoch") * F.col("_whole") - F.col("_before")  # tokens left when the block's turn comes
    epochs = epochs.withColumn("_room", room).filter(F.col("_room") > 1e-6 * F.col("_whole")).select(
        "_source", "_block", "_epoch",
        ((F.col("_epoch") * F.col("_whole") + F.col("_before")) / F.col("_budget")).alias("_place"),
        F.when(F.col("_room") < F.col("_size") * (1 - 1e-9), F.col("_room")).alias("_left"))
    # Only the last block of a source is cut, at a point of its documents' hashed order.
    inside = Window.partitionBy("_source", "_block", "_epoch").orderBy("_u").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        _meeting(placed.select("_source", "_block", "_u", "_tokens"), epochs.filter("_left IS NOT NULL"))
        .withColumn("_used", F.coalesce(F.sum("_tokens").over(inside), F.lit(0))).filter("_used < _left")
        .groupBy("_source", "_block", "_epoch").agg(F.max("_u").alias("_upto"))
        .withColumnsRenamed({"_source": "_s", "_block": "_b", "_epoch": "_e"})
    )
    epochs = epochs.join(
        ends, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")) & (F.col("_epoch") == F.col("_e")), "left")
    return placed, saved(epochs.select(
        "_source", "_block", "_epoch", "_place",
        F.when(F.col("_left").isNull(), F.lit(1.0)).otherwise(F.coalesce("_upto", F.lit(-1.0))).alias("_upto")), "schedule")


def _meeting(docs: DataFrame, epochs: DataFrame) -> DataFrame:
    """Documents with the blocks of every epoch they are in."""
    when = epochs.withColumnsRenamed({"_source": "_name", "_block": "_number"})
    return docs.join(when, F.col("_source").eqNullSafe(F.col("_name")) & (F.col("_block") == F.col("_number"))).drop("_name", "_number")


def mixed(docs: DataFrame, source: str = "source", doc_id: str = "doc_id", text: str = "text", max_repeats: float | None = 1.25,
          target_entropy: float | None = None, budget: int | None = None, block_tokens: int = BLOCK_TOKENS, tokens: Column | None = None) -> DataFrame:
    """Every document as often as its source's budget takes it, with ``_tokens``, ``_epoch``, ``_block`` and ``_place``.

    Sorted by ``_place`` (then ``_u``) the rows are the mixture.  A source may
    end one document over its budget (or that document's copies).  A null source is a source, null
    texts have one token, null ids and repeated rows are documents of their
    own (rows of one id share a block), an empty table gives no rows.  An
    extra column with the name of a result, or of a step to it, raises; ``repeated`` takes any names.
    """
    unclashing(docs.columns, ADDED)
    placed, epochs = schedule(docs, source, doc_id, token_count(text) if tokens is None else tokens, max_repeats, target_entropy, budget, block_tokens)
    # One row per million tokens: texts stay where they are while a job proves that it fits a broadcast.
    epochs = F.broadcast(epochs) if is_small(epochs) else epochs
    return _meeting(placed, epochs).filter(F.col("_u") <= F.col("_upto")).drop("_upto")


def repeated(docs: DataFrame, source: str = "source", doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``mixed`` with the columns of ``docs``, whatever their names."""
    inner, of, back = sealed(docs)
    return back(mixed(inner, of[source], of[doc_id], of[text], **options))
