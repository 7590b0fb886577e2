"""Registered queries of this package, over the driver's tables."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from terraloom.session import ship
from terraloom.llm import chat, collocations, mixing, packing, partenum, phrases, pivots, quality, reputation, sharding, treebpe, variants, warc

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        @functools.wraps(fn)
        def run(spark, sf):
            ship(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op8_sampled_splitters")
def op8(spark, sf):
    return sharding.by_bytes(table(spark, sf, "documents"), 16).withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query("op7_risk_controlled")
def op7(spark, sf):
    df = quality.judged(table(spark, sf, "documents"), table(spark, sf, "labels"), keep=["doc_id"])
    return df.select(
        "doc_id", "_q.n_words", "_q.word_chars", "_q.n_symbols", "_q.n_dup_lines", "_q.n_repeat_words",
        F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


#: The rules of the contract.
URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
]


@query("op5_host_reputation")
def op5(spark, sf):
    outcomes = table(spark, sf, "labels").select(
        F.col("doc_id").alias("page_id"), F.greatest(1 - F.col("quality"), F.col("toxic")).alias("bad"))
    return reputation.judged(table(spark, sf, "pages"), outcomes, URL_RULES)


@query("op6_content_addressed", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
    g AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
    SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
        array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + (((('0x' || substr(h, (5 * (k // 4) + 1)::INT, 5))::BIGINT) >> (15 - 5 * (k % 4))::INT) & 31)::INT, 1)), '') AS payload_digest,
        CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> first THEN first END AS refers_to,
        TRUE AS verified
    FROM g""")
def op6(spark, sf):
    folder = warc.new_folder(spark)
    warc.write(table(spark, sf, "pages"), folder, min_bytes=0)
    return warc.parsed(warc.records(spark, folder))


@query("op10_prefix_free_parsing")
def op10(spark, sf):
    df = phrases.deduplicated(table(spark, sf, "documents"), 50, keep=["doc_id"], with_text=False)
    return df.select("doc_id", *[F.col(f"_{c}").alias(c) for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])


@query("op1_nnls_packing")
def op1(spark, sf):
    return packing.packed(table(spark, sf, "documents"), tokenizer())


@query("op2_partenum")
def op2(spark, sf):
    return partenum.joined(table(spark, sf, "documents"))


@query("op4_pivot_permutation")
def op4(spark, sf):
    return pivots.near_duplicates(table(spark, sf, "embeddings"), 0.9)


@query("op3_temperature_mixing")
def op3(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", mixing.token_count("text").alias("n_tokens"))
    df = mixing.mixed(docs, max_repeats=1.25, tokens=F.col("n_tokens"))
    return df.select("doc_id", "source", "n_tokens", F.col("_epoch").alias("epoch"), F.col("_block").alias("block"), F.col("_place").alias("place"))


@query("op9_role_repair")
def op9(spark, sf):
    return chat.repaired(table(spark, sf, "conversations"))


@query("op11_tree_concatenation")
def op11(spark, sf):
    path = tokenizer("byte_bpe_50k.json")
    df = treebpe.decoded(treebpe.encoded(table(spark, sf, "documents"), path), path)
    return df.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), treebpe.ids_digest("ids").alias("ids_sha256"),
                     F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


@query("op12_position_index")
def op12(spark, sf):
    return variants.grouped(table(spark, sf, "documents"))


@query("op13_three_way_quicksort", """
    WITH t AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM t),
    g AS (SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
          FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(ws) >= m),
    f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
    tot AS (SELECT lang, count(*) AS n FROM g WHERE m = 1 GROUP BY lang),
    c AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS ws, a FROM f WHERE m >= 2),
    inner_ AS (SELECT DISTINCT lang, array_to_string(ws[i:i + k - 1], ' ') AS phrase, a
               FROM c, (SELECT unnest([2, 3, 4]) AS k), (SELECT unnest([1, 2, 3, 4]) AS i) WHERE k < m AND i + k - 1 <= m),
    top AS (SELECT lang, phrase, max(a) AS a FROM inner_ GROUP BY ALL),
    kept AS (SELECT c.* FROM c LEFT JOIN top ON c.lang = top.lang AND c.phrase = top.phrase WHERE top.a IS NULL OR 100 * top.a < 100 * c.a),
    cut AS (SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS x, array_to_string(ws[k + 1:], ' ') AS y
            FROM kept, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE k < m),
    s AS (SELECT cut.lang, cut.phrase, cut.a, k, x.a AS l, y.a AS r, n,
              (1000::HUGEINT * cut.a * n // (x.a::HUGEINT * y.a))::BIGINT AS score
          FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.x JOIN f y ON y.lang = cut.lang AND y.phrase = cut.y JOIN tot ON tot.lang = cut.lang),
    low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM low QUALIFY rank <= 2000""")
def op13(spark, sf):
    return collocations.mined(table(spark, sf, "documents"))
