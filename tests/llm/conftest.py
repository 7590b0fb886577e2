import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that the operators use inside, or return.
    T.StructField("chunk", T.StringType()), T.StructField("bucket", T.StringType()), T.StructField("n_words", T.StringType()),
    T.StructField("shard", T.StringType()), T.StructField("doc", T.StringType()), T.StructField("component", T.StringType()),
    *[T.StructField(n, T.StringType()) for n in "_n _w _s _l _label_of _good _stratum _cuts _keep _key _text _word".split()],
])
#: Names of results: only where the function returns the columns of its input.
RESULTS = "_q _base_failed _kept _chunk _u _tokens _epoch _block _place _source _n_bytes _kept_sha256".split()
EXTRA = len(SCHEMA) - 5
WORDS = [a + b for a in "ba be bi bo bu da de di do du".split() for b in "lan lon mar mor nis nus per por ten tor".split()]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def table(spark, rows):
    """(doc_id, text[, lang, source]) rows with clashing extra columns."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, "en", "a")[:4] if len(row) == 2 else (*row, "a")[:4]
        full.append((doc_id, text, lang, source, len(text or ""), *"abcdefghijklmnopqrstuvwxyz"[:EXTRA]))
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, other scripts."""
    rng = random.Random(5)
    base = [prose(rng, 300) for _ in range(4)]
    rows = [
        (1, base[0]), (2, base[0]), (3, base[0].upper()), (4, base[1]), (5, base[1].replace(" ", "\n", 3)), (6, base[2] + " " + base[3]),
        (7, base[3]), (8, None), (9, ""), (10, " \t\n "), (11, "one two"), (12, "one two"), (13, "One TWO"), (14, prose(rng, 60_000)),
        (15, "x" * 5000), (16, "ab " * 3000), (17, "éß中文 \U0001f600 " * 60), (18, "a\x00b c\x1cd e f <|endoftext|> g " * 20),
        (None, base[0]), (None, None), (4, base[1]), (4, base[2]), (-5, base[3][: len(base[3]) // 2]), ((1 << 53) + 1, base[0] + " end"),
    ]
    full = [(i, t, None if k % 7 == 3 else "en", None if k % 5 == 2 else f"s{k % 3}", *[None] * (EXTRA + 1)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
