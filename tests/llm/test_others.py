"""Operators on embeddings, pages and conversations, and the registered queries and the pipeline."""

import base64
import hashlib
import itertools
import math
import random

import numpy as np
import pytest
import corpus_pipeline
from tests.llm import test_documents as brute
from pyspark.sql import functions as F
from terraloom.llm import chat, graph, pivots, quality, queries, reputation, warc
from terraloom.session import shared_folder

SF = "/root/testdata/sf0.001"


# Graph

def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)]
    links += [(5, 5), (None, 7), (8, None), (900, 900), *links[:10]]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    rng.shuffle(links)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(parent)}


# Embeddings

def brute_links(rows, least=0.9):
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    count, parent = [0] * len(ok), list(range(len(ok)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, (_, x)), (b, (_, y)) in itertools.combinations(enumerate(ok), 2):
        if len(x) == len(y) and np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= least:
            count[a] += 1
            count[b] += 1
            p, q = sorted((find(a), find(b)), key=lambda k: ok[k][0])
            parent[q] = p
    out = [(i, count[k], ok[find(k)][0]) for k, (i, _) in enumerate(ok)]
    used = {id(v) for _, v in ok}
    return sorted((*out, *((i, 0, i) for i, v in rows if id(v) not in used or i is None)), key=str)


def clustered(rng, groups, copies, noise, dim=16):
    out = []
    for _ in range(groups):
        centre = rng.normal(size=dim)
        out += [(centre + noise * rng.normal(size=dim) * rng.random()).astype(np.float32).tolist() for _ in range(copies)]
    return out


def near(df, **options):
    got = pivots.near_duplicates(df, **options).collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str)


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 16)
    rng = np.random.default_rng(2)
    vectors = clustered(rng, 6, 12, 0.15) + clustered(rng, 1, 120, 0.1) + clustered(rng, 80, 1, 0)
    vectors += [vectors[0], vectors[0], vectors[1][:8], None, [], [0.0] * 16, [1.0, None] * 8, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15]
    rows = [*enumerate(vectors), (None, vectors[3]), (3, vectors[3])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, node string, weight int").repartition(6)
    assert near(df) == brute_links(rows)
    assert near(df.limit(0)) == []
    assert near(df.filter("embedding IS NULL")) == [(i, 0, i) for i, v in rows if v is None]


def test_recall_of_links_near_the_threshold(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other = rng.normal(size=base.shape)
    other -= (other * base).sum(1, keepdims=True) * base
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cos = 0.9 + 0.02 * rng.random(len(base))[:, None]
    both = np.concatenate([base, cos * base + np.sqrt(1 - cos * cos) * other])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(both)], "vec_id long, embedding array<double>").repartition(8)
    got = {i: n for i, n, _ in near(df)}
    want = (np.triu(both @ both.T, 1) >= 0.9)
    assert sum(got.values()) / 2 >= 0.93 * want.sum()
    assert sum(got.values()) / 2 <= want.sum()


# URL filter

def test_beta_tail_by_summing_binomials():
    for a, b, x in [(1, 1, 0.3), (3, 9, 0.3), (40, 60, 0.35), (1, 200, 0.01), (700, 300, 0.72)]:
        n = a + b - 1
        want = sum(math.comb(n, k) * x ** k * (1 - x) ** (n - k) for k in range(a))  # P(Beta(a, b) > x)
        assert reputation.beta_above(x, np.array([a]), np.array([b]))[0] == pytest.approx(want, rel=1e-9, abs=1e-14)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def expected_rule(host, path):
    fits = [(say, r) for say, r in queries.URL_RULES
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    return max(fits, key=lambda f: len(f[1]), default=(None, None))


def test_urls(spark):
    urls = ["http://EXAMPLE.org/es/1?x=/en/", "https://a.example.org/en/17", "example.org/en/1", None, "", "ftp://b.com", "x://b.com?/fr/", "x://b.com/fr/#a", "http://b.com/de/a://c",
            "http://notorg/x", "http://forg.com/de", "http://forg.com/de/", "http://org/", "http://x.org#/a", "http://ÀB.Org/ü", "a\nb://c.ORG/d\ne", "http://u@h.com:80/fr/", "http://a.co.uk/p"] * 2
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)] + [(None, urls[0], "h", "r")], "page_id long, url string, host string, rule string")
    none = spark.createDataFrame([], "page_id long, bad int")
    got = reputation.judged(pages, none, queries.URL_RULES).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        host, path = parts(urls[r.page_id or 0])
        say, rule = expected_rule(host, path)
        assert (r.host, r.path, r["rule"]) == (host, path, rule) and r.verdict == (say or "allow")
    assert reputation.judged(pages.limit(0), none, queries.URL_RULES).collect() == []


def test_reputation_shrinks_and_blocks(spark):
    hosts = [("bad.spam.net", 400, 320), ("new.spam.net", 0, 0), ("more.spam.net", 300, 260), ("good.site.net", 500, 20), ("few.site.net", 2, 2), ("a.other.com", 300, 12), ("", 3, None)]
    pages, outcomes, n = [], [], 0
    for host, labelled, bad in hosts:
        for k in range(max(labelled, 3)):
            pages.append((n, f"http://{host}/p{k}" if host else "nothing"))
            if k < labelled:
                outcomes.append((n, None if bad is None else int(k < bad)))
            n += 1
    df = spark.createDataFrame(pages, "page_id long, url string")
    out = spark.createDataFrame(outcomes + outcomes[:5] + [(None, 1)], "page_id long, bad int")
    got = {r.host: r for r in reputation.judged(df, out, []).collect()}
    assert {h: r.verdict for h, r in got.items()} == {
        "bad.spam.net": "block", "more.spam.net": "block", "new.spam.net": got["new.spam.net"].verdict, "good.site.net": "allow", "few.site.net": "allow", "a.other.com": "allow", "": "allow"}
    assert got["new.spam.net"]["mean"] > 0.5 and 0.9 > got["few.site.net"]["mean"] > got["good.site.net"]["mean"]


# WARC

def archive(spark, rows, **options):
    df = spark.createDataFrame([(i, u, h, "x", b"y") for i, u, h in rows], "page_id long, url string, html string, record_type string, payload binary").repartition(3)
    folder = warc.new_folder(spark)
    warc.write(df, folder, **options)
    return folder


def test_archive(spark):
    rows = [(3, "http://a/", "same"), (1, "http://b/\r\nWARC-Type: revisit\r\n", "same"), (2, None, "same"), (4, "http://c/", None), (5, "http://d/", ""), (6, "u", "é\r\n\r\nWARC/1.1\r\n"),
            (7, "u", "x" * 300_000), (8, "u", "x" * 300_000), (None, "u", "same"), (None, "u", "only"), (9, "u", "twice"), (9, "u", "twice")]
    folder = archive(spark, rows)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes) for r in warc.parsed(warc.records(spark, folder)).collect()), key=str)
    want, seen = [], {}
    for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        body = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((i, "revisit" if body in seen else "response", seen.get(body), digest, len(body)))
        seen.setdefault(body, i)
    assert got == sorted(want, key=str)
    assert spark.read.parquet(f"{folder}/payloads").count() == len(seen)
    for r in warc.records(spark, folder).collect():
        record = bytes(r.record)
        head, body = record.split(b"\r\n\r\n", 1)
        size = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and len(body) == size + 4 and body.endswith(b"\r\n\r\n")
        assert body[:size] in (b"", bytes(r.payload))
    assert all(r.verified for r in warc.parsed(warc.records(spark, folder)).collect())


def test_archive_of_small_and_no_payloads(spark):
    folder = archive(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], min_bytes=5)
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.parsed(warc.records(spark, folder)).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}
    assert warc.parsed(warc.records(spark, archive(spark, []))).collect() == []


# Chat

def cheapest(roles):
    """By trying every sequence of steps."""
    best = {"none": 0}
    for role in roles:
        nxt = {}
        for state, cost in best.items():
            for to in ("system", "user", "assistant"):
                change = 0 if to == role else 4 if role in ("system", "user", "assistant") else 2
                ways = ([0] if to in chat.NEXT[state] else []) + ([1] if to == state else []) + [5 for x in chat.NEXT[state] if to in chat.NEXT[x]]
                for way in ways:
                    nxt[to] = min(nxt.get(to, 1e9), cost + change + way)
        best = nxt
    return min(c + 5 * len(chat.CLOSING[s]) for s, c in best.items())


def legal(rendered):
    state = "none"
    for turn in rendered.split(chat.OPEN)[1:]:
        role = turn.split("\n", 1)[0]
        assert role in chat.NEXT[state] and turn.endswith(f"{chat.CLOSE}\n")
        state = role
    return state in ("none", "assistant")


@pytest.mark.parametrize("block", [2, 4096])
def test_roles(spark, block):
    rng = random.Random(block)
    rows, roles = [], {}
    for conv in range(120):
        turns = [rng.choice(["user", "user", "assistant", "assistant", "system", "tool", None]) for _ in range(rng.randint(1, 9))]
        if conv < 20:
            turns = ["user", "assistant"] * 3
        roles[conv] = turns
        rows += [(conv, k - 3, r, f"{conv}.{k}") for k, r in enumerate(turns)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "n", 1) for r in rows], "conv_id long, turn long, role string, text string, action string, cost int")
    got = chat.repaired(df, block=block).collect()
    assert len(got) == len(rows)
    for conv, turns in roles.items():
        mine = sorted((r for r in got if r.conv_id == conv), key=lambda r: r.turn)
        text = "".join(r.rendered for r in mine)
        assert sum(r.cost for r in mine) == cheapest(turns) and legal(text)
        at = [text.index(f"{conv}.{k}") for k in range(len(turns))]
        assert at == sorted(at)
        if conv < 20:
            assert {r.action for r in mine} == {"keep"}


def test_odd_conversations(spark):
    rows = [(None, 1, "user", "a"), (None, None, None, None), (5, None, "user", "<|im_start|>"), (5, None, "assistant", "x"), (5, 2, "user", "q"), (5, 2, "user", "q"), (5, 2, "user", "q"), (6, 0, "system", "s")]
    got = chat.repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == len(rows)
    for conv in (None, 5, 6):
        mine = sorted((r for r in got if r.conv_id == conv), key=lambda r: (r.part, r.place))
        assert [r.turn is None for r in mine] == sorted(r.turn is None for r in mine)
        assert legal("".join(r.rendered for r in mine)) and sum(r.cost for r in mine) == cheapest([r.role for r in mine])
    assert any("insert" in r.action or r.rendered.count(chat.OPEN) > 1 for r in got if r.conv_id == 6)
    assert chat.repaired(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_rows_without_a_turn_are_spread(spark):
    """Distinct ones and copies, of one conversation: many parts, several tasks, and still the cheapest legal rendering."""
    rows = [(7, None, ["user", "assistant", "tool"][k % 3], f"t{k % 900}") for k in range(3000)] + [(7, None, "user", "copy")] * 3000 + [(7, 1, "user", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.repaired(df, block=64)
    got = sorted(out.collect(), key=lambda r: (r.part, r.place))
    assert len(got) == len(rows) and got[0].turn == 1 and len({r.part for r in got}) > 200
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    assert legal("".join(r.rendered for r in got)) and sum(r.cost for r in got) == cheapest([r.role for r in got])
    assert chat.repaired(df.orderBy("text"), block=64).select("part", "place", "rendered").exceptAll(out.select("part", "place", "rendered")).count() == 0


# Registered queries

TABLE = {"op4_pivot_permutation": "embeddings", "op5_host_reputation": "pages", "op6_content_addressed": "pages", "op9_role_repair": "conversations"}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_has_every_row(spark, name):
    df = queries.QUERIES[name](spark, SF)
    rows = spark.read.parquet(f"{SF}/{TABLE.get(name, 'documents')}.parquet").count()
    if name[:5] in ("op12_", "op13_"):  # a row per word or phrase
        assert df.count() > 0 and len(set(df.columns)) == len(df.columns)
    else:
        assert df.count() == rows if name[:4] not in ("op1_", "op3_") else df.count() >= rows


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_oracle(spark, name):
    import check

    assert check.compare(queries.QUERIES[name](spark, SF), check.oracle(SF), queries.ORACLES[name]) == ""


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_native_quality_has_no_python(spark, plan_of):
    plan = plan_of(quality.counted(spark.read.parquet(f"{SF}/documents.parquet")))
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Exchange"))


def test_pipeline_against_brute_force(spark):
    """Each stage on its predecessor's rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    folder = shared_folder(spark)

    def kept(df, name):
        path = f"{folder}/test-{name}-{random.random()}"
        df.write.parquet(path)
        return spark.read.parquet(path)

    a = kept(stages["quality_rules"](spark, docs, SF), "a")
    verdict = {r.doc_id: r["_kept"] for r in quality.judged(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    for i, t in brute.rows_of(docs):
        n, _, _, _, repeated = brute.counts(t)
        assert not verdict[i] or not (n < 50 or 100 * repeated > 50 * n)
    assert sorted(r.doc_id for r in a.collect()) == sorted(i for i, k in verdict.items() if k)
    b = kept(stages["near_duplicates"](spark, a, SF), "b")
    groups = brute.linked(brute.word_sets(brute.rows_of(a)))
    assert sorted(r.doc_id for r in b.collect()) == sorted(d for d, _, c in groups if d == c)
    c = kept(stages["repeated_passages"](spark, b, SF), "c")
    want = brute.without_repeats(brute.rows_of(b))
    assert sorted((r.doc_id, r.text, r.n_chars) for r in c.collect()) == sorted((w[0], w[5], len(w[5])) for w in want)
    d = kept(stages["source_mixture"](spark, c, SF), "d")
    assert {r.doc_id for r in d.collect()} == {r.doc_id for r in c.collect()} and d.count() <= 1.4 * c.count()
    assert [x.columns for x in (a, b, c, d)] == [columns] * 4
    brute.unpacked(brute.rows_of(d), stages["token_packing"](spark, d, SF).collect())
    assert corpus_pipeline.run(spark, SF).count() > 0
