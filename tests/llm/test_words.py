"""Tree concatenation, spelling variants and collocations against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tests.llm.conftest import prose, table
from terraloom.llm import collocations, treebpe, variants
from terraloom.llm.queries import QUERIES, tokenizer

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PATH = tokenizer("byte_bpe_50k.json")


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# Tree concatenation

@pytest.fixture(scope="module")
def encoder():
    return treebpe.Encoder(PATH)


PIECES = ["a", "aaaa", "ab", " ", "  ", "\n", "'", "'s", "'re", "'ll", "x1", "12", "é", "中文", "。", "\U0001f600", "<|endoftext|>", "<|endof", "\x1c",
          "\xa0", "the", "ing", "...", "!!", "\t", "A", "́", "0", "　"]


@pytest.mark.parametrize("seed", range(8))
def test_tree_gives_the_tokenizers_ids(encoder, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(treebpe, "UNSPLIT", 8 if seed % 2 else 256)
    monkeypatch.setattr(treebpe, "EDGE", 16 if seed % 4 > 1 else 1024)
    monkeypatch.setattr(treebpe, "EDGES", 4 if seed % 4 > 1 else 32)
    for _ in range(60):
        some = rng.sample(PIECES, rng.choice([1, 2, 3, len(PIECES)]))
        text = "".join(rng.choice(some) for _ in range(rng.choice([3, 20, 60, 300])))
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        whole = encoder.tree(encoder.parts(encoder.cuts(text, rng.choice([1, 3, 17, 64]) if len(text) < 300 else 40)))
        assert whole.length == len(text) and whole.ids.tolist() == want
        assert encoder.text(want) == text


@pytest.mark.parametrize("text", ["a" * 30_000, " " * 20_000, "abcdefgh" * 3000, "ab'" * 9000, "中" * 9000])
def test_long_unsplit_text(encoder, text):
    whole = encoder.tree(encoder.parts(encoder.cuts(text, 1000)))
    assert whole.ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_decoding_is_the_tokenizers(encoder):
    rng = np.random.default_rng(0)
    for _ in range(300):
        ids = rng.integers(0, 50_257, 20).tolist()
        assert encoder.text(ids) == encoder.tokenizer.decode(ids, skip_special_tokens=False)


def test_windows_stay_small(encoder, monkeypatch):
    """Only windows round the joins are encoded anew, not the sides."""
    text = prose(random.Random(2), 20_000)
    parts = encoder.parts(encoder.cuts(text, 4000))
    seen, real = [], encoder.pretokens
    monkeypatch.setattr(encoder, "pretokens", lambda t: seen.append(len(t)) or real(t))
    assert encoder.tree(parts).ids.tolist() == encoder.tokenizer.encode(text).ids
    assert len(seen) < 4 * len(parts) and max(seen) < 300


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        treebpe.Encoder(tokenizer("word_bpe_49k.json"))


def test_encoded_rows(spark, odd, empty, encoder):
    for df, leaf in ((odd, 700), (documents(spark), treebpe.LEAF), (documents(spark).repartition(5), 900)):
        want = Counter((r.doc_id, tuple(encoder.tokenizer.encode(r.text or "", add_special_tokens=False).ids), r.text or "")
                       for r in df.select("doc_id", "text").collect())
        got = treebpe.decoded(treebpe.encoded(df, PATH, leaf=leaf), PATH).collect()
        assert Counter((r.doc_id, tuple(r.ids), r.text) for r in got) == want
    assert treebpe.encoded(empty, PATH).collect() == []


def test_digests(spark, encoder):
    got = {r.doc_id: r for r in QUERIES["op11_tree_concatenation"](spark, SF).collect()}
    for r in documents(spark).collect():
        ids = encoder.tokenizer.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


# Spelling variants

def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def counted(rows, least_length=5, least_count=3):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= least_length and n >= least_count}


def expected_forms(words):
    by_gap = {}
    for w in words:  # words one edit apart share a word with one letter left out, or one is the other's
        for k in range(len(w)):
            by_gap.setdefault(w[:k] + w[k + 1:], set()).add(w)
    near = {w: set() for w in words}
    for gap, group in by_gap.items():
        for w in group:
            near[w] |= {x for x in group | ({gap} & words.keys()) if x != w and one_edit(w, x)}
            if gap in words and gap != w:
                near[gap].add(w)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-words[x], x))
            if words[best] >= 2 * words[w]:
                form[w] = best
    out = set()
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    return out


def test_variants(spark, odd, empty):
    for df in (documents(spark), odd):
        words = counted([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
        got = [tuple(r) for r in variants.grouped(df).collect()]
        assert len(got) == len(words) > 0 and set(got) == expected_forms(words)
    assert variants.grouped(empty).collect() == []


@pytest.mark.parametrize("alphabet,lengths", [("ab", (1, 7)), ("abé", (5, 9)), ("abcdefghij", (4, 6)), ("ab", (9, 30))])
def test_near_words_in_crowded_groups(spark, alphabet, lengths):
    """Groups far above the block size are cut into blocks, none of whose pairs is lost."""
    rng = random.Random(len(alphabet) + lengths[0])
    words = {}
    for _ in range(500):
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(*lengths)))
        for _ in range(2):
            k = rng.randrange(len(w))
            words[w] = rng.randint(1, 50)
            w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(alphabet) + w[k:], w[:k] + rng.choice(alphabet) + w[k + 1:]]) or "a"
    want = {}
    for w in words:
        near = [x for x in words if abs(len(x) - len(w)) <= 1 and one_edit(w, x)]
        if near:
            best = min(near, key=lambda x: (-words[x], x))
            want[w] = (len(near), best, words[best])
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    for block, dealt in ((5, 300), (2048, 50_000)):
        got = {r.word: (r.n_near, r.best, r.best_n) for r in variants.neighbours(df, block, dealt).collect()}
        assert got == want


def test_very_long_words(spark):
    long = "ab" * 4000
    df = spark.createDataFrame([(long, 9), (long[1:], 2), (long + "c", 3), ("c" + long[1:], 4), ("other", 5)], "word string, n long")
    got = {r.word: r.n_near for r in variants.neighbours(df).collect()}
    assert got == {long: 3, long[1:]: 2, long + "c": 1, "c" + long[1:]: 2}


# Collocations

def pieces(rows):
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            yield lang or "und", [w for w in re.split("[ \t]+", piece) if w]


def expected_collocations(rows, least, top):
    f, n = Counter(), Counter()
    for lang, words in pieces(rows):
        n[lang] += len(words)
        f.update((lang, tuple(words[i: i + m])) for m in range(1, 6) for i in range(len(words) - m + 1))
    frequent = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = {}
    for (lang, p), a in frequent.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                inside[lang, p[i: i + m]] = max(inside.get((lang, p[i: i + m]), 0), a)
    out = {}
    for (lang, p), a in frequent.items():
        if inside.get((lang, p), 0) < a:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right, n[lang]))
    return [(lang, rank, p.decode(), -a, left, right, m, -score) for lang, rows in out.items()
            for rank, (score, a, p, left, right, m) in enumerate(sorted(rows)[:top], 1)]


@pytest.mark.parametrize("size,sent", [(1 << 20, 4_000_000), (2000, 4_000_000), (2000, 0), (150, 0)])
def test_collocations(spark, odd, empty, size, sent):
    for df, least, top in ((documents(spark), 20, 2000), (odd, 3, 50)):
        want = expected_collocations([(r.lang, r.text) for r in df.select("lang", "text").collect()], least, top)
        got = [tuple(r) for r in collocations.mined(df, least=least, top=top, size=size, sent=sent).collect()]
        assert sorted(got) == sorted(want) and want
    assert collocations.mined(empty, size=size, sent=sent).collect() == []


def test_a_very_common_phrase_spans_ranges(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["one two three four five six seven"] + [prose(rng, 5).replace(".", "").replace(",", "")])) for i in range(600)]
    df = table(spark, rows).repartition(9)
    want = expected_collocations([("en", t) for _, t in rows], 50, 2000)
    assert sorted(tuple(r) for r in collocations.mined(df, least=50, size=100).collect()) == sorted(want)


@pytest.mark.parametrize("seed", range(5))
def test_three_way_counts(seed):
    rng = np.random.default_rng(seed)
    numbers = rng.integers(0, 4, 3000).astype("<i4")
    rows = collocations.suffixes(numbers, 4)
    rows, counts = collocations.merged(rows, np.ones(len(rows), np.int64))
    want = Counter(tuple(numbers[i: i + m].tolist()) for m in (2, 3, 4) for i in range(len(numbers) - m + 1) if numbers[i: i + m].all())
    shuffled = rng.permutation(len(rows))
    got = collocations.three_way(rows[shuffled], counts[shuffled], 10)
    assert dict(got) == {p: a for p, a in want.items() if a >= 10} and len(dict(got)) == len(got)


def test_very_long_text_is_cut(spark):
    text = prose(random.Random(1), 4000)
    numbers = collocations.Numbers(None, 0)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "en"]), pa.array([text, text])], names=["lang", "_text"])
    whole = np.concatenate(list(collocations._batches([batch], numbers, 5, 10**6)))
    parts = np.concatenate(list(collocations._batches([batch], numbers, 5, 300)))
    assert Counter(map(tuple, whole.tolist())) == Counter(map(tuple, parts.tolist()))


def test_exact_scores(spark):
    a, n, left, right = 99_999_999_999_999_989, 99_999_999_999_999_999, 99_999_999_999_999_990, 99_999_999_999_999_991
    df = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    assert df.select(collocations.score("a", "n", "l", "r")).first()[0] == 1000 * a * n // (left * right)
