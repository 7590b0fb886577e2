"""N-gram Jaccard join by PartEnum signatures.

Documents are sets of hashed word shingles.  Two sets of sizes a and b with
Jaccard similarity 3/4 or more differ in at most (a + b) // 7 elements.  Sizes
fall into bands that grow by four; in a band the shingle domain is cut into
partitions, and a signature is a partition with all of the set's elements in
it.  The enumerated subsets are the single partitions, of which there are more
than differences: each difference spoils one partition at most, so similar sets
agree on all but ``k`` of their non-empty ones.  A set near the lower end of
its band takes part in the band below as well.  Sets with too few non-empty
partitions for that argument (small ones) also use the finest cut, one element
a partition, among themselves.

Signatures that no other document has count against a set's ``k``; sets with
more than ``k`` of these have no partner and drop out.  The others look for
partners under their rarest shared signatures only.  Candidates are checked on
the whole sets: first each document against the least one under a signature,
then, where a signature still spans several components, the rest of its pairs.
Equal texts are one class from the beginning.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from terraloom.llm.common import bytes_of, listed, saved, sealed
from terraloom.llm.graph import components

WORDS = 5
CHUNK_BYTES, BUCKET_BYTES, BLOCK = 4 << 20, 16 << 20, 256
#: Elements a partition holds at most on average, for the largest sets of a band.
FILL = 2.2
LOW40 = np.uint64((1 << 40) - 1)

_rng = np.random.default_rng(75)
_ODD = _rng.integers(1 << 62, (1 << 63) - 1, 32, dtype=np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = _rng.integers(0, (1 << 63) - 1, 256, dtype=np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[str, np.ndarray] = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _ODD[30]
    return x ^ (x >> np.uint64(29))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 21)
        for name, base in (("up", int(_ODD[0])), ("down", pow(int(_ODD[0]), -1, 1 << 64))):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[name] = np.cumprod(x, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def shingles(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The distinct hashed shingles of each text, ascending.

    A-Z are lower-cased; words are runs without blanks.  A text with fewer words
    than a shingle has one element, its whole sequence; without words, none.
    """
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        size, stop = 0, at
        while stop < len(texts) and (stop == at or size + len(texts[stop]) < (1 << 20)):
            size += len(texts[stop]) + 1
            stop += 1
        out += _shingles(texts[at:stop], words)
        at = stop
    return out


def _shingles(texts: list[bytes], words: int) -> list[np.ndarray]:
    joined = b" " + b" ".join(texts).lower() + b" "
    buf = np.frombuffer(joined, np.uint8)
    blank = _BLANK[buf]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    first, last = edge[::2], edge[1::2]
    up, down = _power(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * up[:-1], out=total[1:])
    word = _mixed((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64) * _ODD[1])
    ends = np.cumsum([len(t) + 1 for t in texts])
    cuts = np.concatenate([[0], np.searchsorted(first, ends)])
    n = len(word) - words + 1
    if n > 0:
        run = word[:n] * _ODD[2]
        for i in range(1, words):
            run += word[i: i + n] * _ODD[2 + i]
        run = _mixed(run)
    out = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b - a >= words:
            out.append(np.unique(run[a: b - words + 1]))
        elif b > a:
            out.append(_mixed((word[a:b] * _ODD[2: 2 + b - a]).sum(keepdims=True) + _ODD[20: 21] * np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def band(size: int) -> int:
    return (size.bit_length() - 1) // 2


def signatures(elements: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(k, signatures) for each band the set takes part in, and for the finest cut where it must.

    A partner shares all signatures of one of these, of its own or of this set, but ``k``.
    """
    n, out = len(elements), []
    if not n:
        return out
    own = band(n)
    for j in (own, own - 1):
        top = 4 ** (j + 1)
        if j < 0 or (j < own and 3 * n >= 4 * top):
            continue
        largest = 4 * n // 3 if j == own else top - 1
        k = (n + largest) // 7
        parts = np.uint64(max(1, math.ceil(4 * top / 3 / FILL)))
        part = ((elements >> np.uint64(32)) * parts) >> np.uint64(32)  # ascends with the elements
        heads = np.flatnonzero(np.diff(part, prepend=np.uint64(1 << 40)))
        body = np.add.reduceat(_mixed(elements + _ODD[21]), heads)
        out.append((k, _mixed(body + part[heads] * _ODD[22] + _ODD[23:24] * np.uint64(2 * j + 1))))
        if len(heads) <= k:
            out.append((k, _mixed(elements * _ODD[24] + _ODD[23:24] * np.uint64(2 * j + 2))))
    return out


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 7 * both >= 3 * (len(a) + len(b))


COUNTS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("low", pa.binary()), ("docs", pa.binary())])
SHARED = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("low", pa.binary()), ("docs", pa.binary())])
FOUND = pa.schema([("doc", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n", pa.int64()), ("body", pa.binary()),
                   ("a", pa.int64()), ("b", pa.int64()), ("bucket", pa.int32()), ("leads", pa.binary()), ("members", pa.binary())])
PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
LEAD = np.dtype([("key", "<u8"), ("doc", "<i8"), ("n", "<i8")])
KINDS = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {KINDS[f.type]}" for f in schema)


def _packed(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


def _five(x: np.ndarray) -> bytes:
    """The lower 40 bits of each number."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _from_five(x: bytes) -> np.ndarray:
    wide = np.zeros((len(x) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(x, np.uint8).reshape(-1, 5)
    return wide.view("<u8")[:, 0]


def _keys(signature: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 40 bits of a signature: enough to meet under, as every pair is checked later."""
    return (((signature >> np.uint64(40)) % np.uint64(buckets)) << np.uint64(40)) | (signature & LOW40)


def _by_bucket(keys: np.ndarray) -> list[tuple[int, slice]]:
    """Runs of a bucket in sorted keys."""
    bucket = (keys >> np.uint64(40)).astype(np.int64)
    cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(keys))
    return [(int(bucket[a]), slice(a, b)) for a, b in zip(cuts[:-1], cuts[1:])]


def _sets(table: pa.Table, buckets: int, words: int):
    """Class leaders of a chunk by id, with their sets and signatures as keys."""
    rows = sorted(range(table.num_rows), key=[(d, a, b) for d, a, b in zip(*(table.column(c).to_pylist() for c in ("doc", "k1", "k2")))].__getitem__)
    table = table.take(pa.array(rows, pa.int64()))
    sets = shingles([t.encode() for t in table.column("text").to_pylist()], words)
    return table, sets, [[(k, _keys(s, buckets)) for k, s in signatures(x)] for x in sets]


def _leaders(docs: pa.Table, leaders: pa.Table) -> pa.Table:
    """The rows of a chunk that lead their class of equal texts."""
    lead = {x for x in zip(*(listed(leaders, c) for c in ("lead", "l1", "l2"))) if x[0] is not None}
    keep, seen = [], set()
    for i, row in enumerate(zip(*(docs.column(c).to_pylist() for c in ("doc", "k1", "k2")))):
        if row in lead and row not in seen:
            seen.add(row)
            keep.append(i)
    return docs.take(pa.array(keep, pa.int64()))


def _propose(buckets: int, words: int):
    def run(table: pa.Table, leaders: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _packed([], COUNTS)
        number = table.column("chunk")[0].as_py()
        _, _, signed = _sets(_leaders(table, leaders), buckets, words)
        each = [np.unique(np.concatenate([s for _, s in x])) for x in signed if x]
        keys, n = np.unique(np.concatenate(each), return_counts=True) if each else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        n = np.minimum(n, 255).astype(np.uint8)
        return _packed([{"bucket": b, "chunk": number, "low": _five(keys[s]), "docs": n[s].tobytes()} for b, s in _by_bucket(keys)], COUNTS)

    return run


def _meet(table: pa.Table) -> pa.Table:
    """Signatures of a bucket that several documents have, for each chunk that has them."""
    chunks, lows = table.column("chunk").to_pylist(), [_from_five(x) for x in table.column("low").to_pylist()]
    docs = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("docs").to_pylist()]).astype(np.int64)
    chunk, low = np.repeat(np.array(chunks, np.int64), [len(x) for x in lows]), np.concatenate(lows)
    _, group = np.unique(low, return_inverse=True)
    total = np.minimum(np.bincount(group, docs).astype(np.int64), 255)[group]
    rows = np.flatnonzero(total > 1)
    rows = rows[np.argsort(chunk[rows], kind="stable")]
    bucket = table.column("bucket")[0].as_py()
    cuts = np.flatnonzero(np.diff(chunk[rows], prepend=-1))
    parts = np.split(rows, cuts[1:]) if len(rows) else []
    return _packed([{"chunk": int(chunk[p[0]]), "bucket": bucket, "low": _five(low[p]), "docs": total[p].astype(np.uint8).tobytes()} for p in parts], SHARED)


def _choose(buckets: int, words: int):
    """Sets that may have partners, their rarest shared signatures, and pairs with the least document of the chunk."""

    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _packed([], FOUND)
        table, sets, signed = _sets(_leaders(table, replies), buckets, words)
        told = [x for x in zip(*(listed(replies, c) for c in ("bucket", "low", "docs"))) if x[0] is not None]
        known = np.concatenate([np.zeros(0, np.uint64), *(_from_five(low) | np.uint64(b << 40) for b, low, _ in told)])
        docs = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(x, np.uint8) for _, _, x in told)])
        order = np.argsort(known)
        known, docs = known[order], docs[order]
        rows, found = [], []
        for i, (doc, k1, k2) in enumerate(zip(*(table.column(c).to_pylist() for c in ("doc", "k1", "k2")))):
            mine = []
            for k, keys in signed[i]:
                if not len(known):
                    continue
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                often = np.where(known[at] == keys, docs[at], 1)
                alone = int((often == 1).sum())
                if alone > k:
                    continue
                shared = np.flatnonzero(often > 1)
                prefix = shared[np.lexsort((keys[shared], often[shared]))][: k + 1 - alone]
                mine.append(np.stack([keys[prefix], often[prefix].astype(np.uint64)], 1))
            body = None
            if any(len(x) for x in mine):
                body = _five(sets[i])
                chosen = np.unique(np.concatenate(mine), axis=0)
                found.append((chosen, doc, len(sets[i])))
            rows.append({"doc": doc, "k1": k1, "k2": k2, "n": len(sets[i]), "body": body})
        if found:
            key = np.concatenate([c[:, 0] for c, _, _ in found])
            often = np.concatenate([c[:, 1] for c, _, _ in found])
            doc = np.repeat(np.array([d for _, d, _ in found], np.int64), [len(c) for c, _, _ in found])
            n = np.repeat(np.array([m for _, _, m in found], np.int64), [len(c) for c, _, _ in found])
            order = np.lexsort((doc, key))
            key, often, doc, n = key[order], often[order], doc[order], n[order]
            body = np.zeros(len(key), LEAD)
            body["key"], body["doc"], body["n"] = key, doc, n
            heads = np.flatnonzero(np.diff(key, prepend=~key[0]))
            lead, pairs = _stars(body, heads)
            rows += [{"a": a, "b": b} for a, b in pairs]
            rows += [{"bucket": b, "leads": lead[s].tobytes()} for b, s in _by_bucket(lead["key"])]
            crowd = body[often > 2]
            rows += [{"bucket": b, "members": crowd[s].tobytes()} for b, s in _by_bucket(crowd["key"])] if len(crowd) else []
        return _packed(rows, FOUND)

    return run


def _stars(rows: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row of each run of a key, and the distinct pairs of that document and the others of like size."""
    lead = rows[heads]
    centre = np.repeat(lead, np.diff(np.append(heads, len(rows))))
    fits = (centre["doc"] < rows["doc"]) & (4 * np.minimum(centre["n"], rows["n"]) >= 3 * np.maximum(centre["n"], rows["n"]))
    pairs = np.stack([centre["doc"][fits], rows["doc"][fits]], 1)
    return lead, np.unique(pairs, axis=0)


def _across(table: pa.Table) -> pa.Table:
    """Pairs of the chunks' least documents under a signature and the least of all."""
    rows = np.concatenate([np.frombuffer(x, LEAD) for x in table.column("leads").to_pylist()])
    rows = rows[np.lexsort((rows["doc"], rows["key"]))]
    heads = np.flatnonzero(np.diff(rows["key"], prepend=~rows["key"][:1]))
    _, pairs = _stars(rows, heads)
    return pa.table([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], schema=PAIRS)


def _unpacked(batches):
    for batch in batches:
        for body in batch.column(0).to_pylist():
            rows = np.frombuffer(body, LEAD)
            yield pa.RecordBatch.from_arrays([pa.array(rows["key"].astype(np.int64)), pa.array(rows["doc"]), pa.array(rows["n"])], ["key", "doc", "n"])


def _checked(batches):
    for batch in batches:
        left, right = batch.column("_left").to_pylist(), batch.column("_right").to_pylist()
        keep = [similar(_from_five(x), _from_five(y)) for x, y in zip(left, right)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are similar, by their whole sets."""
    left = sets.select(F.col("doc").alias("a"), F.col("body").alias("_left"))
    right = sets.select(F.col("doc").alias("b"), F.col("body").alias("_right"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "_left", "_right").mapInArrow(_checked, "a long, b long")


def _rest(crowd: DataFrame, sets: DataFrame, tasks: int) -> DataFrame:
    """Links across components under the signatures of ``crowd`` (key, doc, component, _lead): a spanning set of them.

    Documents that signatures connect are cut into blocks, large components
    into some of their own.  Two blocks meet once, if a signature is in both and
    they are not one component already; what they find comes back as links, not pairs.
    """
    clusters = components(crowd.select("_lead", "doc"), "_lead", "doc").withColumnsRenamed({"node": "doc", "component": "_cluster"})
    docs = crowd.select("doc", "component").distinct().join(clusters, "doc", "left").withColumn("_cluster", F.coalesce("_cluster", "doc"))
    large = docs.groupBy("component").agg(F.count(F.lit(1)).alias("_m")).filter(F.col("_m") > BLOCK // 2)
    docs = docs.join(large, "component", "left")
    small = docs.filter("_m IS NULL").groupBy("_cluster").agg(F.count(F.lit(1)).alias("_s"))
    docs = docs.join(small, "_cluster", "left")

    def part(of: str, rows: str):
        return F.pmod(F.xxhash64(of), F.ceil(F.col(rows) / BLOCK))

    docs = saved(docs.select("doc", "component", F.when(
        F.col("_m").isNotNull(), F.xxhash64(F.lit(1), "component", part("doc", "_m"))).otherwise(
        F.xxhash64(F.lit(2), "_cluster", part("component", "_s"))).alias("block")), "blocks")
    seen = crowd.select("key", "doc").join(docs, "doc").groupBy("key", "block").agg(F.min("component").alias("_x"), F.max("component").alias("_y"))
    one, two = (seen.select("key", F.col("block").alias(b), F.col("_x").alias(f"_x{i}"), F.col("_y").alias(f"_y{i}")) for i, b in ((1, "low"), (2, "high")))
    meetings = saved(one.join(two, "key").filter("low <= high AND NOT (_x1 = _y1 AND _x2 = _y2 AND _x1 = _x2)").select("low", "high").distinct(), "meetings")
    sides = meetings.select("low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("block"))
    placed = sides.join(docs, "block").join(sets, "doc").withColumn("share", F.pmod(F.xxhash64("low", "high"), F.lit(max(tasks, 1))).cast("int"))
    # A task's share is one meeting at a time where there are many.
    group = F.struct("share", F.pmod(F.xxhash64("high", "low"), F.lit(64)).alias("part"))
    return placed.withColumn("_group", group).groupBy("_group").applyInArrow(_met_blocks, _ddl(PAIRS)).distinct()


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Elements in common of every set of one side with every one of the other."""
    x, y = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(x, y)
    rows_x, rows_y = (np.repeat(np.arange(len(s)), [len(e) for e in s]) for s in (left, right))
    (in_x, at_x), (in_y, at_y) = _where(both, x), _where(both, y)
    out = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, len(both), 4096):
        a, b = np.zeros((len(left), 4096), np.float32), np.zeros((len(right), 4096), np.float32)
        for grid, rows, found, at in ((a, rows_x, in_x, at_x), (b, rows_y, in_y, at_y)):
            use = found & (at >= low) & (at < low + 4096)
            grid[rows[use], at[use] - low] = 1
        out += a @ b.T
    return out


def _where(values: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(values, x), max(len(values) - 1, 0))
    return (values[at] == x if len(values) else np.zeros(len(x), bool)), at


def _met_blocks(table: pa.Table) -> pa.Table:
    low, high, block, doc, part = (np.array(table.column(c).to_pylist(), np.int64) for c in ("low", "high", "block", "doc", "component"))
    bodies, found = table.column("body"), []
    order = np.lexsort((doc, block, high, low))
    cuts = np.flatnonzero((np.diff(low[order], prepend=low[order[0]] - 1) != 0) | (np.diff(high[order], prepend=high[order[0]] - 1) != 0))
    for rows in np.split(order, cuts[1:]):
        sets = [_from_five(bodies[int(i)].as_py()) for i in rows]
        size = np.array([len(s) for s in sets])
        x, y = np.flatnonzero(block[rows] == low[rows]), np.flatnonzero(block[rows] == high[rows])
        common = _overlaps([sets[i] for i in x], [sets[i] for i in y])
        near = (7 * common >= 3 * (size[x][:, None] + size[y][None, :])) & (part[rows][x][:, None] != part[rows][y][None, :])
        a, b = np.nonzero(near)
        a, b = x[a], y[b]
        _, root = np.unique(part[rows], return_inverse=True)
        names = np.arange(root.max() + 1)
        ends = np.stack([root[a], root[b]])
        while len(a):  # keep links that join components not joined yet
            hooked = names.copy()
            top, bottom = np.maximum(*names[ends]), np.minimum(*names[ends])
            use = top != bottom
            if not use.any():
                break
            first = np.unique(top[use], return_index=True)
            at = np.flatnonzero(use)[first[1]]
            found.append(np.stack([doc[rows][a[at]], doc[rows][b[at]]], 1))
            hooked[first[0]] = bottom[at]
            while (hooked[hooked] != hooked).any():
                hooked = hooked[hooked]
            names = hooked[names]
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    return pa.table([pa.array(pairs.min(1)), pa.array(pairs.max(1))], schema=PAIRS)


def joined(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id of every document: the smallest id it reaches by links of
    Jaccard similarity 3/4 or more between sets of ``words``-word shingles.

    Null and blank texts have empty sets and link with nothing, copies of
    them neither.  Rows of one id share a component.  A null id gets its
    ``n_shingles``, but no component and no links.  An empty table gives no
    rows; other columns are not read.
    """
    spark = docs.sparkSession
    total, tasks = bytes_of(docs, text), int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = min(tasks, math.ceil(total / (1 << 18)))
    chunks, buckets = max(math.ceil(total / CHUNK_BYTES), spread, 1), max(math.ceil(total / BUCKET_BYTES), spread, 1)
    body = F.coalesce(F.col(text), F.lit(""))
    named = docs.select(
        F.col(doc_id).cast("long").alias("doc"), F.xxhash64(body).alias("k1"), F.xxhash64(F.lit(75), body, F.length(body)).alias("k2"), body.alias("text"))
    # Equal texts: one leader for each, the least id.
    classes = named.groupBy("k1", "k2").agg(F.min("doc").alias("doc"), F.min(F.when(F.col("doc").isNull(), 1).otherwise(0)).alias("_none"))
    nobody = F.lit(-(1 << 63)).cast("long")  # leads texts that only null ids have, and meets no one
    # Texts of null ids are spread by their hash.
    home = F.when(F.col("doc") == nobody, F.col("k1")).otherwise(F.col("doc"))
    chunk = F.pmod(F.xxhash64(home, F.lit(2)), F.lit(chunks)).cast("int").alias("chunk")
    filled = F.coalesce("doc", nobody).alias("doc")
    leaders = classes.select(filled, "k1", "k2").select(F.col("doc").alias("lead"), F.col("k1").alias("l1"), F.col("k2").alias("l2"), chunk)
    texts = named.select(filled, "k1", "k2", "text").select("*", chunk)
    # Texts are shuffled once: both passes group the same exchange.
    by_chunk = texts.groupBy("chunk")
    shared = by_chunk.cogroup(leaders.groupBy("chunk")).applyInArrow(_propose(buckets, words), _ddl(COUNTS)).groupBy("bucket").applyInArrow(_meet, _ddl(SHARED))
    replies = leaders.unionByName(shared, allowMissingColumns=True)
    found = saved(by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(_choose(buckets, words), _ddl(FOUND)), "partenum")

    sets = found.filter(F.col("body").isNotNull() & (F.col("doc") != nobody)).select("doc", "body")
    real = (F.col("a") != nobody) & (F.col("b") != nobody)
    pairs = saved(
        found.filter(F.col("a").isNotNull()).select("a", "b")
        .union(found.filter(F.col("leads").isNotNull()).select("bucket", "leads").groupBy("bucket").applyInArrow(_across, _ddl(PAIRS)))
        .filter(real).distinct(), "pairs")
    links = saved(_links(pairs, sets), "similar")
    parts = components(links)

    # Signatures that still span components: the rest of their pairs, block by block.
    members = (
        found.filter(F.col("members").isNotNull()).select("members").mapInArrow(_unpacked, "key long, doc long, n long")
        .filter(F.col("doc") != nobody).select("key", "doc")
        .join(parts.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc")))
    mixed = members.groupBy("key").agg(F.min("component").alias("_x"), F.max("component").alias("_y"), F.min("doc").alias("_lead")).filter("_x <> _y")
    crowd = saved(members.join(mixed.select("key", "_lead"), "key"), "crowd")
    more = saved(_rest(crowd, sets, tasks), "similar")
    parts = components(links.union(more)) if more.take(1) else parts

    told = named.drop("text").join(
        found.filter(F.col("n").isNotNull()).select(F.col("doc").alias("_lead"), "k1", "k2", "n"), ["k1", "k2"], "left")
    told = told.join(parts.select(F.col("node").alias("_lead"), "component"), "_lead", "left")
    own = F.when(F.col("n") == 0, F.col("doc")).otherwise(F.coalesce("component", "_lead"))
    return told.select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("doc").isNotNull(), own).alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are the least of their component, with their columns; rows of null ids all stay."""
    keep = joined(docs, doc_id, text).filter("component_id = doc_id").select(F.col("doc_id").alias("_keep")).distinct()
    inner, of, back = sealed(docs)
    own = F.col(of[doc_id])
    return back(inner.join(keep, own == F.col("_keep"), "left_semi").union(inner.filter(own.isNull())))
