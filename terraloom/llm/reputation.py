"""URL filter by empirical-Bayes host reputation.

Labelled page outcomes are counted per host, registered domain and suffix.
Every level's bad rate is shrunk towards the level above by a beta prior whose
weight is estimated from the spread between its members (method of moments on
the beta-binomial), so a host with few labels inherits its domain's rate and a
host without labels takes it over.  A host is blocked when its posterior puts
at least ``sure`` probability on a bad rate above ``worst``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from terraloom.llm.common import A_TO_Z

#: Suffixes of two labels; any other suffix is the last label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; '' for null or without ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, A_TO_Z, A_TO_Z.lower())


def path(url: Column) -> Column:
    """After the host up to ``? #`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix(host: Column) -> Column:
    labels = F.split(host, "\\.")
    last = F.element_at(labels, -1)
    two = F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)))
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(last)


def domain(host: Column) -> Column:
    """The suffix with one label before it; the host itself where there is none."""
    labels, own = F.split(host, "\\."), F.size(F.split(suffix(host), "\\.")) + 1
    count = F.least(F.size(labels), own)
    return F.concat_ws(".", F.slice(labels, F.size(labels) - count + 1, count))


def _log_beta(a, b):
    return _lgamma(a) + _lgamma(b) - _lgamma(a + b)


_lgamma = np.vectorize(math.lgamma, otypes=[float])


def beta_above(x: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """P(Beta(a, b) > x) by the continued fraction of the incomplete beta function."""
    a, b = np.asarray(a, float), np.asarray(b, float)
    flip = x > (a + 1) / (a + b + 2)
    p, q, t = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1 - x, x)
    tiny = 1e-300
    front = np.exp(p * np.log(t) + q * np.log1p(-t) - _log_beta(p, q)) / p
    c = np.ones_like(p)
    d = 1 - (p + q) * t / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    total = d.copy()
    for m in range(1, 2000):
        for top in (
            m * (q - m) * t / ((p + 2 * m - 1) * (p + 2 * m)),
            -(p + m) * (p + q + m) * t / ((p + 2 * m) * (p + 2 * m + 1)),
        ):
            d = 1 + top * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + top / np.where(np.abs(c) < tiny, tiny, c)
            total = total * d * c
        if np.all(np.abs(d * c - 1) < 1e-14):
            break
    below = np.where(flip, 1 - front * total, front * total)
    return np.clip(1 - below, 0.0, 1.0)


def _shrunk(members: DataFrame, level: str, above: DataFrame | None, upper: str | None, weakest: float, strongest: float) -> DataFrame:
    """Add ``_mean`` and ``_weight`` (of the prior for the level below) to each member's counts.

    ``members``: level, [upper], n, bad.  The weight of the prior is estimated
    from the member rates around the rate above, all members counted.
    """
    if above is not None:
        members = members.join(above.select(upper, F.col("_mean").alias("_prior"), F.col("_weight").alias("_strength")), upper, "left")
    else:
        members = members.withColumns({"_prior": F.lit(0.5), "_strength": F.lit(2.0)})
    return members.withColumns({
        "_a": F.col("_prior") * F.col("_strength") + F.col("bad"),
        "_b": (1 - F.col("_prior")) * F.col("_strength") + F.col("n") - F.col("bad"),
    }).withColumn("_mean", F.col("_a") / (F.col("_a") + F.col("_b")))


def _weights(children: DataFrame, parent: str, weakest: float, strongest: float) -> DataFrame:
    """Prior weight per parent by the method of moments over its children's counts.

    With rates r_i of n_i outcomes around the pooled rate m, the extra spread
    rho solves sum n_i (r_i - m)^2 = m (1 - m) (k - 1 + rho (N - sum n_i^2 / N - (k - 1)));
    the weight is (1 - rho) / rho, kept between ``weakest`` and ``strongest``.
    """
    s = (
        children.filter(F.col("n") > 0).groupBy(parent)
        .agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("N"), F.sum("bad").alias("B"),
             F.sum(F.col("n") * F.col("n")).cast("double").alias("n2"),
             F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("b2"))
    )
    m = F.col("B") / F.col("N")
    spread = F.col("b2") - F.col("B") * m
    room = m * (1 - m)
    extra = F.col("N") - F.col("n2") / F.col("N") - (F.col("k") - 1)
    rho = F.when((room > 0) & (extra > 0), (spread / room - (F.col("k") - 1)) / extra).otherwise(F.lit(0.0))
    weight = F.when(rho > 0, (1 - rho) / rho).otherwise(F.lit(float(strongest)))
    return s.select(parent, F.greatest(F.lit(float(weakest)), F.least(F.lit(float(strongest)), weight)).alias("_weight"))


def reputations(outcomes: DataFrame, worst: float = 0.3, sure: float = 0.9, weakest: float = 2.0, strongest: float = 1000.0) -> DataFrame:
    """``_host`` and ``_bad`` (1, 0, null) of pages -> host, n, bad, mean, above, blocked: one row per host.

    Hosts without labelled pages are included.  Counting is pre-aggregated, so
    a host with most of the pages is one row after the scan.
    """
    hosts = (
        outcomes.groupBy(F.col("_host").alias("host"))
        .agg(F.count("_bad").alias("n"), F.coalesce(F.sum("_bad"), F.lit(0)).cast("long").alias("bad"))
        .withColumns({"domain": domain(F.col("host")), "suffix": suffix(F.col("host")), "all": F.lit(0)})
    )
    domains = hosts.groupBy("domain", "suffix", "all").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix", "all").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    everything = suffixes.groupBy("all").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def with_weight(level: DataFrame, name: str, children: DataFrame) -> DataFrame:
        return level.join(_weights(children, name, weakest, strongest), name, "left").fillna({"_weight": float(weakest)})  # without labels below it

    top = with_weight(_shrunk(everything, "all", None, None, weakest, strongest), "all", suffixes)
    level = with_weight(_shrunk(suffixes, "suffix", top, "all", weakest, strongest), "suffix", domains)
    level = with_weight(_shrunk(domains.drop("all"), "domain", level, "suffix", weakest, strongest), "domain", hosts)
    final = _shrunk(hosts.drop("suffix", "all"), "host", level, "domain", weakest, strongest)

    @F.pandas_udf("double")
    def above(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(beta_above(worst, a.to_numpy(), b.to_numpy()))

    return final.withColumn("above", above("_a", "_b")).select(
        "host", "n", "bad", F.col("_mean").alias("mean"), "above", (F.col("above") >= sure).alias("blocked"))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls where none does.

    ``rules``: (verdict, host + path) such as ("block", "example.org/es/").  A
    rule fits its host and all subdomains where the path starts with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, text in sorted(rules, key=lambda r: len(r[1])):  # longer rules are asked first
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, say).otherwise(verdict)
    return rule, verdict


def judged(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], page_id: str = "page_id", url: str = "url", **options) -> DataFrame:
    """Every page with host, path, rule, verdict, and its host's labels, mean and tail probability.

    ``outcomes``: page_id and bad (1, 0; null or absent: unlabelled; the worst of
    several counts).  Null urls and urls without ``://`` share the empty host.
    Null ids are judged by their url; repeated rows each give a row; extra
    columns are not read; empty tables give no rows.
    """
    bad = outcomes.filter(F.col("bad").isNotNull()).groupBy(F.col("page_id").alias("_label_of")).agg(F.max(F.col("bad").cast("int")).alias("_bad"))
    df = pages.select(F.col(page_id).alias("page_id"), host(F.col(url)).alias("_host"), path(F.col(url)).alias("path"))
    known = df.join(bad, df["page_id"] == bad["_label_of"], "left")
    told = reputations(known.select("_host", "_bad"), **options)
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return (
        df.join(told, df["_host"] == told["host"], "left")
        .withColumns({"rule": rule, "_ruled": verdict})
        .select("page_id", "host", "path", "rule",
                F.coalesce("_ruled", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
                "n", "bad", "mean", "above")
    )
