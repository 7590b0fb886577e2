"""Quality rules whose cutoffs are certified on labelled holdouts.

Every document gets counts and ratios by built-in functions.  For each stratum
and ratio a ladder of cutoffs, fixed beforehand, is tested from loose to strict
on the labelled good documents: a cutoff is certified while the exact binomial
(Clopper-Pearson) upper bound of its false rejections stays within that ratio's
share of the allowance.  Stopping at the first failure makes the ladder one
test, and the error level is divided by the number of strata and ratios
(Bonferroni), so with probability ``1 - delta`` no stratum loses more than
``allowed`` of its good documents.  Among the certified cutoffs the one that
rejects most labelled bad documents (less the good ones) is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from terraloom.llm.common import A_TO_Z, BLANK_RUN, saved, sealed, unclashing

SYMBOLS = "#*$%&|<>"

#: Ladders of cutoffs, loose to strict; a document is rejected above the cutoff.
LADDERS = {
    "symbols_per_word": [2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05],
    "repeat_share": [0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1],
    "dup_line_share": [0.8, 0.6, 0.5, 0.4, 0.3, 0.2],
    "upper_share": [0.9, 0.7, 0.5, 0.3, 0.2],
    "marks_per_word": [1.5, 0.9, 0.7, 0.5, 0.4],
    "word_length": [30.0, 20.0, 15.0, 12.0, 10.0],
}


def words_of(text: str | Column) -> Column:
    """Words of a text: runs without blanks; null and blank texts have none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK_RUN), lambda w: w != "")


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _covered(places: Column) -> Column:
    """Words inside 3-word windows that start at the sorted places."""
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))

    def step(acc, place):
        return F.struct((acc.n + F.least(F.lit(3), place - acc["last"])).alias("n"), place.alias("last"))

    return F.aggregate(places, start, step, lambda acc: acc.n)


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``_q`` of counts; no shuffle, no Python.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), and
    n_lines, n_upper, n_marks for the ratios.  A null text counts as empty.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("_w", words_of(text)).withColumn("_n", F.size("_w"))
    windows = F.greatest(F.col("_n") - 2, F.lit(0))

    def part(first: int) -> Column:
        return F.slice("_w", F.lit(first), windows)

    pairs = F.zip_with(part(1), part(2), lambda a, b: F.xxhash64(a, b))
    hashes = F.zip_with(pairs, part(3), lambda ab, c: F.xxhash64(ab, c))
    numbered = F.zip_with(
        hashes, F.sequence(F.lit(0), F.greatest(windows - 1, F.lit(0))),
        lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("_s", F.when(windows > 1, F.sort_array(numbered)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    rest = F.greatest(F.size("_s") - 1, F.lit(0))
    twins = F.filter(
        F.zip_with(F.slice("_s", F.lit(1), rest), F.slice("_s", F.lit(2), rest),
                   lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i))),
        lambda pair: pair.isNotNull())
    places = F.sort_array(F.array_distinct(F.flatten(twins)))
    lines = F.filter(F.split(body, "\n"), lambda line: F.length(F.translate(line, " \t\n\u000b\f\r", "")) > 0)
    df = df.withColumn("_l", lines)
    return df.withColumn("_q", F.struct(
        F.col("_n").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.length(body) - _without(body, SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        _covered(places).cast("long").alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.length(body) - _without(body, A_TO_Z)).cast("long").alias("n_upper"),
        (F.length(body) - _without(body, "!?")).cast("long").alias("n_marks"),
    )).drop("_w", "_n", "_s", "_l")


def base_failed(q: str = "_q") -> Column:
    q = F.col(q)
    return (q.n_words < 50) | (100 * q.n_repeat_words > 50 * q.n_words)


def ratios(q: str = "_q") -> dict[str, Column]:
    """The ratios the cutoffs apply to; 0 where there is nothing to divide by."""
    q = F.col(q)

    def share(a: Column, b: Column) -> Column:
        return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))

    return {
        "symbols_per_word": share(q.n_symbols, q.n_words),
        "repeat_share": share(q.n_repeat_words, q.n_words),
        "dup_line_share": share(q.n_dup_lines, q.n_lines),
        "upper_share": share(q.n_upper, q.word_chars),
        "marks_per_word": share(q.n_marks, q.n_words),
        "word_length": share(q.word_chars, q.n_words),
    }


def most_failures(n: Column, rate: float, level: Column) -> Column:
    """Largest k with P(Binomial(n, rate) <= k) <= level, -1 if there is none.

    That is the largest number of false rejections whose exact upper bound at
    ``level`` is within ``rate``.  Sums in log space, over fewer than n * rate + 2 terms.
    """
    odds = F.lit(rate / (1 - rate))
    n = n.cast("double")
    start = F.struct(
        (n * F.log(F.lit(1 - rate))).alias("term"), F.lit(float("-inf")).cast("double").alias("sum"), F.lit(-1).alias("k"))

    def step(acc, i):
        top = F.greatest(acc["sum"], acc.term)
        total = top + F.log(F.exp(acc["sum"] - top) + F.exp(acc.term - top))
        term = F.when(n > i, acc.term + F.log((n - i) / (i + 1) * odds)).otherwise(F.lit(float("-inf")).cast("double"))
        return F.struct(term.alias("term"), total.alias("sum"),
                        F.when(total <= F.log(level), i).otherwise(acc.k).cast("int").alias("k"))

    return F.aggregate(F.sequence(F.lit(0), F.ceil(n * rate).cast("int")), start, step, lambda acc: acc.k)


def certified(judged: DataFrame, stratum: str, allowed: float, delta: float, ladders: dict = LADDERS) -> DataFrame:
    """One row per stratum and ratio with a certified cutoff: _stratum, rule, cutoff, n_good, n_lost.

    ``judged`` has ``_q``, the stratum and ``_good`` (1, 0, or null without a label).
    Strata meet with null as a value of its own.
    """
    labelled = judged.filter(F.col("_good").isNotNull())
    cuts = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(step).alias("step"), F.lit(cut).alias("cutoff"), (ratios()[rule] > cut).alias("hit"))
        for rule, ladder in ladders.items() for step, cut in enumerate(ladder)
    ])
    tried = (
        labelled.select(F.col(stratum).alias("_stratum"), "_good", F.inline(cuts))
        .groupBy("_stratum", "rule", "step", "cutoff")
        .agg(F.sum("_good").alias("n_good"), F.sum(1 - F.col("_good")).alias("n_bad"),
             F.sum(F.when(F.col("hit"), F.col("_good")).otherwise(0)).alias("n_lost"),
             F.sum(F.when(F.col("hit"), 1 - F.col("_good")).otherwise(0)).alias("n_caught"))
    )
    strata = tried.agg(F.countDistinct(F.struct("_stratum")).alias("_strata")).scalar()
    level = F.lit(delta / len(ladders)) / strata
    ladder = Window.partitionBy("_stratum", "rule").orderBy("step")  # at most one row per cutoff
    best = Window.partitionBy("_stratum", "rule").orderBy(F.desc("_gain"), "step")
    limits = (
        tried.select("_stratum", "n_good").distinct().withColumn("_level", level)
        .withColumn("_most", most_failures(F.col("n_good"), allowed / len(ladders), F.col("_level")))
        .drop("_level", "n_good")
    )
    return (
        tried.join(limits, tried["_stratum"].eqNullSafe(limits["_stratum"])).drop(limits["_stratum"])
        .withColumn("_failed", F.sum((F.col("n_lost") > F.col("_most")).cast("int")).over(ladder))
        .filter(F.col("_failed") == 0)
        .withColumn("_gain", F.col("n_caught") / F.greatest(F.col("n_bad"), F.lit(1)) - F.col("n_lost") / F.greatest(F.col("n_good"), F.lit(1)))
        .withColumn("_place", F.row_number().over(best))
        .filter((F.col("_place") == 1) & (F.col("n_caught") > 0))
        .select("_stratum", "rule", "cutoff", "n_good", "n_lost")
    )


def judged(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang",
           keep: list[str] | None = None, allowed: float = 0.03, delta: float = 0.05) -> DataFrame:
    """Columns ``keep`` of every document with ``_q``, ``_base_failed`` and ``_kept``.

    ``labels`` holds ``doc_id`` and ``quality`` (1 good, 0 bad; a document with
    both counts as bad, one with null as unlabelled).  A stratum, or a whole
    table, with too few labels certifies nothing and only the base rules reject.
    Null texts have no words and fail the base rules.  Null ids, repeated rows
    and extra columns are kept as they are; one in ``keep`` with the name of a
    result raises, ``kept`` takes any names.
    """
    told = list(keep or docs.columns)
    unclashing(told, ("_q", "_base_failed", "_kept"))
    docs, of, _ = sealed(docs)
    doc_id, text, stratum, keep = of[doc_id], of[text], of[stratum], [of[c] for c in told]
    marks = labels.filter(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("_label_of")).agg(
        F.min(F.col("quality").cast("int")).alias("_good"))
    kept = [F.col(f"`{c}`") for c in dict.fromkeys([*keep, doc_id, stratum])]
    df = saved(counted(docs, text).select(*kept, "_q"), "quality")
    cuts = certified(
        df.join(marks, F.col(f"`{doc_id}`") == marks["_label_of"]).select(F.col(f"`{stratum}`"), "_q", "_good"), stratum, allowed, delta)
    # One row per stratum with a map of at most one cutoff per rule.
    cuts = cuts.groupBy("_stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cuts"))
    hits = [F.coalesce(value > F.col("_cuts")[rule], F.lit(False)) for rule, value in ratios().items()]
    rejected = hits[0]
    for hit in hits[1:]:
        rejected = rejected | hit
    out = df.join(cuts, F.col(f"`{stratum}`").eqNullSafe(cuts["_stratum"]), "left")
    return out.select(
        *[F.col(c).alias(name) for c, name in zip(keep, told)], "_q", base_failed().alias("_base_failed"),
        (~base_failed() & ~rejected).alias("_kept"))


def kept(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    inner, of, back = sealed(docs)
    named = {k: of[options.get(k, default)] for k, default in (("doc_id", "doc_id"), ("text", "text"), ("stratum", "lang"))}
    return back(judged(inner, labels, **{**options, **named}).filter("_kept"))
