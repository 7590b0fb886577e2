"""Operators on documents against brute force, on odd rows, empty tables and the smallest tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tests.llm.conftest import prose, table
from terraloom.llm import mixing, packing, partenum, phrases, quality, sharding
from terraloom.llm.queries import tokenizer

SF = "/root/testdata/sf0.001"
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# Packing

def unpacked(rows, got):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer())
    want = Counter()
    for doc, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        want[doc, np.array(ids, "<u4").tobytes()] += 1
    lengths = defaultdict(list)
    for (doc, ids), n in want.items():
        lengths[doc] += [ids] * n
    by_window, covered = defaultdict(list), Counter()
    for r in got:
        by_window[r.sequence_id].append((r.offset, r.length))
        fits = [ids for ids in lengths[r.doc_id] if len(ids) // 4 == r.doc_tokens
                and zlib.crc32(ids[4 * r.start: 4 * (r.start + r.length)]) == r.ids_crc32]
        assert fits
        covered[r.doc_id] += r.length
    assert covered == {d: sum(len(i) // 4 for i in ids) for d, ids in lengths.items()}
    for places in by_window.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= 4096
    assert sorted(by_window) == list(range(len(by_window)))
    return 1 - sum(covered.values()) / (4096 * len(by_window))


def test_packing(spark, odd, empty):
    rows = documents(spark)
    assert unpacked(rows_of(rows), packing.packed(rows, tokenizer()).collect()) < 0.03
    unpacked(rows_of(odd), packing.packed(odd, tokenizer()).collect())
    assert packing.packed(empty, tokenizer()).collect() == []


def test_packing_of_one_length(spark):
    df = table(spark, [(i, "one two three " * 400) for i in range(300)]).repartition(7)
    unpacked(rows_of(df), packing.packed(df, tokenizer()).collect())


@pytest.mark.parametrize("seed", range(6))
def test_patterns_use_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    histogram = [0, *rng.integers(0, [1, 3, 50, 5000][seed % 4], 64)]
    used, rooms = Counter(), 0
    for pattern, n in packing.patterns(histogram, 64):
        assert sum(pattern) <= 64 and n > 0
        for u in pattern:
            used[u] += n
        rooms += n * (64 - sum(pattern))
    assert [used[i] for i in range(65)] == histogram
    if seed % 4 == 3:
        assert rooms < 0.08 * sum(i * h for i, h in enumerate(histogram))


def test_nnls_meets_the_conditions():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, b = rng.normal(size=(12, 30)), rng.normal(size=12)
        x = packing.nnls(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and slope.max() < 1e-6 and np.abs(slope[x > 1e-9]).max(initial=0) < 1e-6


# N-gram join

def word_sets(rows):
    out = []
    for doc, text in rows:
        w = BLANK.findall((text or "").translate(LOWER))
        out.append((doc, frozenset(tuple(w[i: i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    return out


def linked(sets):
    parent = {d: d for d, _ in sets if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            where[x].append(k)
    for k, (d, s) in enumerate(sets):
        for j, both in Counter(j for x in s for j in where[x] if j < k).items():
            e, t = sets[j]
            if d is not None and e is not None and 100 * both >= 75 * (len(s) + len(t) - both):
                a, b = sorted((find(d), find(e)))
                parent[b] = a
    return Counter((d, len(s), None if d is None else find(d)) for d, s in sets)


def joined(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in partenum.joined(df).collect())


def test_join(spark, odd, empty):
    df = documents(spark)
    assert joined(df) == linked(word_sets(rows_of(df)))
    assert joined(odd) == linked(word_sets(rows_of(odd)))
    assert joined(empty) == {}


def family(rng, words, copies, edits):
    base = prose(rng, words).split()
    for _ in range(copies):
        w = list(base)
        for at in rng.sample(range(len(w)), rng.randint(0, edits)):
            w[at] = rng.choice(["new", "other", "third"]) + str(rng.randint(0, 9))
        yield " ".join(w)


def test_join_of_large_families(spark, monkeypatch):
    """Near copies around the threshold, small sets, and a passage many share; blocks are small."""
    monkeypatch.setattr(partenum, "BLOCK", 16)
    rng = random.Random(3)
    texts = [*family(rng, 120, 150, 8), *family(rng, 60, 80, 5), *family(rng, 25, 60, 2), *family(rng, 9, 60, 1), *family(rng, 7, 40, 1)]
    shared = prose(rng, 60)
    texts += [prose(rng, 30) + " " + shared + " " + prose(rng, rng.randint(1, 40)) for _ in range(80)]
    rng.shuffle(texts)
    df = table(spark, list(enumerate(texts))).repartition(5)
    got = joined(df)
    assert got == linked(word_sets(rows_of(df)))
    assert len({c for _, _, c in got}) > 20


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 7, 15, 16, 17, 21, 40, 63, 64, 85, 200, 1000])
def test_similar_sets_share_a_signature(size):
    rng = np.random.default_rng(size)
    for _ in range(30):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.int64).astype(np.uint64))
        other = rng.integers(0, size // 3 + 1)
        b = np.unique(np.concatenate([a[rng.random(size) < 0.9], rng.integers(0, 1 << 63, other, dtype=np.int64).astype(np.uint64)]))
        if len(b) and partenum.similar(a, b):
            sides = [[(k, set(s.tolist())) for k, s in partenum.signatures(x)] for x in (a, b)]
            assert any(len(s & t) >= max(len(s) - k, len(t) - m, 1) for k, s in sides[0] for m, t in sides[1])


def test_one_of_each_keeps_columns(odd):
    kept = partenum.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 2 not in ids and 3 not in ids and ids.count(None) == 2 and {8, 9, 10} <= set(ids)


# Repeated strings

def without_repeats(rows, length=50):
    last = 1 << 63
    seen, out, at = {}, [], 0
    rows = sorted(rows, key=lambda r: last if r[0] is None else r[0])
    for doc, text in rows:
        key, b = last if doc is None else doc, (text or "").encode()
        for p in range(len(b) - length + 1):
            seen.setdefault(b[p: p + length], key)
    for doc, text in rows:
        key, b = last if doc is None else doc, (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p: p + length]] < key:
                gone[p: p + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), None if text is None else kept.decode(errors="ignore")))
    return Counter(out)


def deduplicated(df, **options):
    return Counter((r.doc_id, r["_n_bytes"], r["_n_removed"], r["_n_spans"], r["_kept_sha256"], r.text) for r in phrases.deduplicated(df, **options).collect())


@pytest.mark.parametrize("hot", [1, 4096])
def test_repeats(spark, odd, empty, hot):
    assert deduplicated(odd, hot=hot) == without_repeats(rows_of(odd))
    df = documents(spark)
    assert deduplicated(df, hot=hot) == without_repeats(rows_of(df))
    assert deduplicated(empty) == {}
    assert phrases.deduplicated(odd).columns[: len(odd.columns)] == odd.columns


def test_repeats_of_shifted_and_periodic_text(spark):
    rng = random.Random(4)
    passage = prose(rng, 20)
    texts = ["ab" * k for k in (24, 25, 26, 60, 300)] + ["a" * k for k in (49, 50, 51, 500)]
    texts += [prose(rng, 5) + passage[k:] + prose(rng, 5) for k in range(0, 60, 7)] + [passage[: 49 + k] for k in range(3)]
    texts += ["".join(rng.choice("ab") for _ in range(400)) for _ in range(30)]
    df = table(spark, [(rng.randint(0, 30), t) for t in texts]).repartition(4)
    assert deduplicated(df) == without_repeats(rows_of(df))


# Quality

def counts(text):
    text = text or ""
    w = BLANK.findall(text)
    often = Counter(tuple(w[i: i + 3]) for i in range(len(w) - 2))
    covered = {i + d for i in range(len(w) - 2) if often[tuple(w[i: i + 3])] > 1 for d in range(3)}
    lines = [line for line in text.split("\n") if BLANK.search(line)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts(spark, odd):
    for df in (odd, documents(spark)):
        got = quality.counted(df).select("text", "_q.*").collect()
        assert len(got) == df.count()
        for r in got:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(r.text)


def test_allowed_failures_are_the_exact_binomial_limit(spark):
    import math
    from pyspark.sql import functions as F

    cases = [(0, 0.01, 0.001), (10, 0.1, 0.05), (200, 0.02, 0.01), (1000, 0.005, 0.002), (5000, 0.003, 0.001), (90, 0.05, 0.5)]
    for n, rate, level in cases:
        got = spark.range(1).select(quality.most_failures(F.lit(n), rate, F.lit(level)).alias("k")).first()["k"]
        total, want = 0.0, -1
        for k in range(n + 1):
            total += math.comb(n, k) * rate ** k * (1 - rate) ** (n - k)
            if total > level:
                break
            want = k
        assert got == want


def test_cutoffs_keep_good_documents(spark, odd, empty):
    rng = random.Random(8)
    rows = [(i, prose(rng, 90)) for i in range(1500)]
    rows += [(i, " ".join(w + "$$$" for w in prose(rng, 120).split())) for i in range(1500, 1600)]
    df = table(spark, rows)
    labels = spark.createDataFrame([(i, int(i < 1500), 0) for i in range(1600)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r["_kept"] for r in quality.judged(df, labels).collect()}
    assert sum(not got[i] for i in range(1500)) <= 0.03 * 1500 and not any(got[i] for i in range(1500, 1600))
    few = labels.filter("doc_id % 50 = 0")
    assert all(r["_kept"] for r in quality.judged(df, few).collect())  # nothing can be certified
    none = labels.limit(0)
    kept = quality.kept(odd, none)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} >= {1, 2, 4, 14}
    assert quality.judged(odd, none).count() == odd.count() and quality.kept(empty, labels).collect() == []


# Sharding

def check_shards(df, shards=16):
    got = sharding.by_bytes(df, shards).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows_of(df))
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        assert 0 <= r.shard < shards
        by[r.shard].append(r)
    for rows in by.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    return got, {s: sum(r["size"] for r in by[s]) for s in range(shards)}


def test_shards(spark, odd, empty):
    got, size = check_shards(documents(spark))
    share, largest = sum(size.values()) / 16, max(r["size"] for r in got)
    assert max(abs(s - share) for s in size.values()) <= largest + 0.02 * share
    check_shards(odd)
    assert sharding.by_bytes(empty, 16).collect() == []


def test_shards_cut_a_hot_group_and_keep_small_ones(spark):
    rng = random.Random(6)
    rows = [(i, "the same text") for i in range(4000)] + [(i, prose(rng, 6)) for i in range(4000, 8000)]
    rows += [(10_000 + i, f"pair {i // 2}") for i in range(400)]
    got, size = check_shards(table(spark, rows))
    assert max(size.values()) - min(size.values()) < 0.03 * sum(size.values()) / 16 + 200
    where = defaultdict(set)
    for r in got:
        where[r.text_crc32].add(r.shard)
    assert sum(len(s) > 1 for s in where.values()) == 1


# Mixing

def test_repeats_follow_the_targets():
    tokens = [1000, 100, 10, 0]
    exponent, often = mixing.repeats(tokens, max_repeats=3.0)
    assert max(often) == pytest.approx(3, abs=1e-6) and min(o for o in often if o) == pytest.approx(1) and often[3] == 0
    exponent, _ = mixing.repeats(tokens, target_entropy=1.0)
    assert mixing.entropy(mixing.weights(tokens, exponent)) == pytest.approx(1.0, abs=1e-9)
    assert mixing.repeats(tokens, max_repeats=1.0)[1] == [1.0, 1.0, 1.0, 0.0]
    assert mixing.repeats([0, 0], max_repeats=2.0)[1] == [0.0, 0.0]
    assert sum(o * t for o, t in zip(mixing.repeats(tokens, max_repeats=9.0, budget=500)[1], tokens)) == pytest.approx(500)


def test_mixture(spark, odd, empty):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randint(5, 60)), "en", "big" if i % 4 else f"s{i % 12}") for i in range(2000)]
    df = table(spark, rows)
    tokens = {i: len(t.split()) + 1 for i, t, _, _ in rows}
    source = {r[0]: r[3] for r in rows}
    total = Counter()
    for i in tokens:
        total[source[i]] += tokens[i]
    _, often = mixing.repeats([total[s] for s in sorted(total)], max_repeats=2.5)
    got = mixing.mixed(df, max_repeats=2.5, block_tokens=500).collect()
    again = Counter((r.doc_id, r["_epoch"]) for r in got)
    assert set(again.values()) == {1} and {i for i, _ in again} == set(tokens)
    used = Counter()
    for r in got:
        used[r.source] += tokens[r.doc_id]
    for s, o in zip(sorted(total), often):
        assert o * total[s] - 1e-6 <= used[s] <= o * total[s] + 62
    # Any stretch of the sorted mixture has about the target weights.
    first = [r for r in got if r["_place"] < 0.5]
    for s, o in zip(sorted(total), often):
        assert sum(tokens[r.doc_id] for r in first if r.source == s) == pytest.approx(used[s] / 2, abs=600)
    mixed = mixing.mixed(odd, max_repeats=1.5)
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in odd.collect()} and mixing.mixed(empty).collect() == []
    assert mixing.mixed(odd, max_repeats=1.0).count() == odd.count()


# Names, ids and limits

def named_like_results(odd):
    from pyspark.sql import functions as F
    from tests.llm.conftest import RESULTS
    return odd.withColumns({n: F.concat(F.lit(n), F.coalesce(F.length("text"), F.lit(-1))) for n in RESULTS})


def test_stages_keep_columns_of_any_name(spark, odd):
    import corpus_pipeline

    docs = named_like_results(odd)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 15)], "doc_id long, quality int")
    was = {(r.doc_id, r.text): tuple(r)[5:] for r in docs.collect()}
    outs = {
        "quality": quality.kept(docs, labels), "near": partenum.one_of_each(docs), "cleaned": phrases.cleaned(docs, 50),
        "mixture": mixing.repeated(docs, max_repeats=1.25),
    }
    for name, df in outs.items():
        assert df.columns == docs.columns
        rows = df.collect()
        assert rows
        if name != "cleaned":
            assert all(was[r.doc_id, r.text] == tuple(r)[5:] for r in rows)
        else:
            assert sorted(map(repr, (tuple(r)[5:] for r in rows))) == sorted(map(repr, (tuple(r)[5:] for r in docs.collect())))
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality_rules"


def test_results_never_overwrite_columns(odd):
    docs = named_like_results(odd)
    for call in (lambda: mixing.mixed(docs), lambda: phrases.deduplicated(docs, 50), lambda: quality.judged(docs, docs)):
        with pytest.raises(ValueError, match="names of results"):
            call()


@pytest.mark.parametrize("length", [0, 27, 84, 100])
def test_length_limits(odd, length):
    with pytest.raises(ValueError, match="length"):
        phrases.deduplicated(odd, length)


def test_large_ids_next_to_null_ones(spark):
    big = (1 << 53) + 1
    df = table(spark, [(big, "one two three " * 30), (None, "four five"), (big + 2, None), (-big, "six")]).coalesce(1)
    assert {r.doc_id for r in packing.packed(df, tokenizer()).collect()} == {big, None, big + 2, -big}
    assert {r.doc_id for r in sharding.by_bytes(df, 2).collect()} == {big, None, big + 2, -big}


def test_whole_tokenizer_where_words_do_not_stand_alone(spark, odd):
    """A file with other rules for text goes through its tokenizer as it is."""
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    encoder, whole = packing.Encoder(path), Tokenizer.from_file(path)
    assert not encoder.by_words and packing.Encoder(tokenizer()).by_words
    texts = [r.text or "" for r in odd.select("text").collect()]
    assert [np.frombuffer(i, "<u4").tolist() for i in encoder.ids(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("seed", range(4))
def test_word_encoder_equals_the_tokenizer(seed):
    from tokenizers import Tokenizer

    rng, encoder, whole = random.Random(seed), packing.Encoder(tokenizer()), Tokenizer.from_file(tokenizer())
    parts = ["a", "B", "é", "ß", "12", "½", "'s", "'", "!?", ".", "),", "<|", "<|endoftext|>", "<|EndOfText|>", " ", "\n", "\x1c", "\x85", "\xa0", "İ", "中", "ſ", "µ", "ÿ",
             "\x00", "\x7f", "-", "É", "́", "x" * 70]
    for _ in range(800):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(encoder.ids([text])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_rows_without_ids_are_spread(spark):
    """No chunk of the joins holds all of them."""
    rng = random.Random(9)
    df = table(spark, [(None, prose(rng, 300)) for _ in range(400)] + [(i, prose(rng, 20)) for i in range(50)])
    got = partenum.joined(df)
    assert got.filter("doc_id IS NULL AND component_id IS NULL AND n_shingles > 0").count() == 400
    assert phrases.deduplicated(df, 50).filter("doc_id IS NULL AND _n_removed = 0").count() == 400
