"""Mixture budgets, host posteriors and quality cutoffs against workings of their own."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from tests.llm.conftest import prose, table
from terraloom.llm import mixing, quality, reputation

# Mixture: a scan over the exponent instead of bisection


def scanned(totals, limit):
    """Tokens by source of the flattest mixture whose sources are gone through at most ``limit`` times and once at least."""
    t = np.array([totals[s] for s in sorted(totals)], float)
    for e in np.arange(0, 1 + 1e-5, 1e-5):
        w = (t / t.sum()) ** e
        w /= w.sum()
        whole = (t / w).max()
        if (w * whole / t).max() <= limit + 1e-9:
            return dict(zip(sorted(totals), w * whole))
    return dict(totals)


@pytest.mark.parametrize("limit", [1.0, 1.25, 2.5, 6.0])
def test_budgets(spark, limit):
    rng = random.Random(int(limit * 4))
    rows = [(i, prose(rng, rng.randint(5, 60)), "en", "big" if i % 3 else f"s{int(math.sqrt(i)) % 5}") for i in range(1500)]
    tokens, source = {r[0]: len(r[1].split()) + 1 for r in rows}, {r[0]: r[3] for r in rows}
    totals = Counter()
    for i, n in tokens.items():
        totals[source[i]] += n
    want, used = scanned(totals, limit), Counter()
    for r in mixing.mixed(table(spark, rows), max_repeats=limit, block_tokens=700).collect():
        used[r.source] += tokens[r.doc_id]
    for s in totals:
        assert want[s] - 0.002 * want[s] - 1 <= used[s] <= want[s] + 0.002 * want[s] + 62


# Reputation: counts in dictionaries, moments by loops, tails by integration

def tail(a, b, x, steps=200_000):
    """P(Beta(a, b) > x) by the midpoint rule."""
    t = (np.arange(steps) + 0.5) / steps
    log = (a - 1) * np.log(t) + (b - 1) * np.log1p(-t)
    density = np.exp(log - log.max())
    return float(density[t > x].sum() / density.sum())


def moments(children):
    """Weight of the prior over (n, bad) counts."""
    some = [(n, k) for n, k in children if n]
    total, bad = sum(n for n, _ in some), sum(k for _, k in some)
    if not some:
        return 2.0
    m = bad / total
    spread = sum(n * (k / n - m) ** 2 for n, k in some)
    extra = total - sum(n * n for n, _ in some) / total - (len(some) - 1)
    if m * (1 - m) <= 0 or extra <= 0:
        return 1000.0
    rho = (spread / (m * (1 - m)) - (len(some) - 1)) / extra
    return min(1000.0, max(2.0, (1 - rho) / rho)) if rho > 0 else 1000.0


def test_posteriors(spark):
    rng = random.Random(4)
    hosts = {f"h{k}.{d}": (n, d, d.rsplit(".", 1)[-1] if not d.endswith("co.uk") else "co.uk") for d, n in
             (("spam.net", 40), ("mixed.net", 30), ("fine.org", 50), ("shop.co.uk", 25), ("one.com", 8)) for k in range(4)}
    hosts["new.spam.net"] = (0, "spam.net", "net")
    hosts["alone.zz"] = (0, "alone.zz", "zz")
    rate = {"spam.net": 0.85, "mixed.net": 0.4, "fine.org": 0.05, "shop.co.uk": 0.3, "one.com": 0.6, "alone.zz": 0.5}
    pages, outcomes, count, n = [], [], {}, 0
    for host, (labelled, d, _) in hosts.items():
        bad = 0
        for k in range(max(2, labelled)):
            pages.append((n, f"http://{host}/{k}"))
            if k < labelled:
                hit = int(rng.random() < rate[d])
                bad += hit
                outcomes.append((n, hit))
            n += 1
        count[host] = (labelled, bad)
    got = {r.host: r for r in reputation.judged(
        spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes, "page_id long, bad int"), []).collect()}

    def added(keys):
        out = defaultdict(lambda: (0, 0))
        for key, (a, b) in keys:
            out[key] = (out[key][0] + a, out[key][1] + b)
        return out

    domains = added((hosts[h][1], c) for h, c in count.items())
    suffix_of = {d: s for _, d, s in hosts.values()}
    suffixes = added((suffix_of[d], c) for d, c in domains.items())
    whole = added((0, c) for c in suffixes.values())[0]

    def mean(prior, weight, counts):
        return (prior * weight + counts[1]) / (weight + counts[0])

    top, top_weight = mean(0.5, 2.0, whole), moments(list(suffixes.values()))
    for host, c in count.items():
        _, d, s = hosts[host]
        of_suffix = mean(top, top_weight, suffixes[s])
        suffix_weight = moments([domains[x] for x in domains if suffix_of[x] == s])
        of_domain = mean(of_suffix, suffix_weight, domains[d])
        weight = moments([count[h] for h in count if hosts[h][1] == d])
        a, b = of_domain * weight + c[1], (1 - of_domain) * weight + c[0] - c[1]
        r = got[host]
        assert (r.n, r.bad) == c and r["mean"] == pytest.approx(a / (a + b), rel=1e-6)
        assert r.above == pytest.approx(tail(a, b, 0.3), abs=2e-4)
        assert r.verdict == ("block" if r.above >= 0.9 else "allow")
    # A host without labels stands where its domain does.
    assert got["new.spam.net"].n == 0 and got["new.spam.net"].verdict == "block" and got["alone.zz"].n == 0


# Quality cutoffs: every ladder walked by hand

def most(n, rate, level):
    total, k = 0.0, -1
    for i in range(n + 1):
        total += math.comb(n, i) * rate ** i * (1 - rate) ** (n - i)
        if total > level:
            return k
        k = i
    return k


def test_cutoffs_and_verdicts(spark):
    rng = random.Random(12)
    rows, good = [], {}
    for i in range(4400):
        lang, bad = ["en", None][i % 2], i % 4 > 2 or i % 8 == 0
        text = prose(rng, 80)
        if bad and i % 3 == 0:
            text = " ".join(w + "##" for w in text.split())
        elif bad:
            text = text.upper()
        elif i % 997 == 0:
            text = " ".join(w + "!" for w in text.split())
        rows.append((i, text, lang))
        if i % 5:
            good[i] = int(not bad)
    docs = table(spark, [(i, t, lang or "xx") for i, t, lang in rows]).replace("xx", None, "lang")
    labels = spark.createDataFrame(list(good.items()), "doc_id long, quality int")
    allowed, delta, ladders = 0.03, 0.05, quality.LADDERS
    got = {r.doc_id: r for r in quality.judged(docs, labels, allowed=allowed, delta=delta).collect()}

    def ratios(q):
        part = lambda a, b: a / b if b else 0.0
        return {"symbols_per_word": part(q.n_symbols, q.n_words), "repeat_share": part(q.n_repeat_words, q.n_words),
                "dup_line_share": part(q.n_dup_lines, q.n_lines), "upper_share": part(q.n_upper, q.word_chars),
                "marks_per_word": part(q.n_marks, q.n_words), "word_length": part(q.word_chars, q.n_words)}

    measured, lang_of = {i: ratios(r["_q"]) for i, r in got.items()}, {i: lang for i, _, lang in rows}
    level = delta / len(ladders) / len({lang_of[i] for i in good})
    cutoffs = {}
    for lang in {lang_of[i] for i in good}:
        mine = [i for i in good if lang_of[i] == lang]
        n_good, n_bad = sum(good[i] for i in mine), sum(1 - good[i] for i in mine)
        limit = most(n_good, allowed / len(ladders), level)
        for rule, ladder in ladders.items():
            best = None
            for cut in ladder:
                hit = [i for i in mine if measured[i][rule] > cut]
                lost, caught = sum(good[i] for i in hit), sum(1 - good[i] for i in hit)
                if lost > limit:
                    break
                gain = caught / max(n_bad, 1) - lost / max(n_good, 1)
                if best is None or gain > best[0] + 1e-15:
                    best = (gain, cut, caught)
            if best and best[2]:
                cutoffs[lang, rule] = best[1]
    assert {rule for _, rule in cutoffs} >= {"symbols_per_word", "upper_share"}
    for i, r in got.items():
        rejected = any(measured[i][rule] > cutoffs.get((lang_of[i], rule), math.inf) for rule in ladders)
        assert r["_kept"] == (not r["_base_failed"] and not rejected)
    assert sum(not r["_kept"] for i, r in got.items() if good.get(i)) <= allowed * sum(good.values())
