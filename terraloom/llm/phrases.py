"""Suffix-array deduplication of repeated byte strings by prefix-free parsing.

A hash of every ``GRAM`` bytes is a trigger where it is the least of any run of
hashes inside ``length`` bytes, so every string of ``length`` bytes holds a
trigger, and equal strings hold equal triggers at equal places.  Triggers cut
the documents into phrases, none a prefix of another.  A string then is a
phrase suffix (what stands left of its trigger) and the beginning of a suffix
of the parse (what stands right of it).  The two are sorted on their own, with
their longest common prefixes, and the pair of their ranks is the string's
place in corpus order: equal pairs are equal strings, and the least document id
of a pair decides.  Phrases that occur in one document only cannot take part
and are not sorted.

Spark does the distribution: documents lie in hashed chunks of a few MB; a
trigger is one row element per chunk, however many copies the chunk holds; equal
triggers meet in hashed buckets, whose answers go back to the chunks.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from terraloom.llm.common import bytes_of, listed, sealed, unclashing

GRAM = 20
#: Lengths of strings that triggers and masks of 64 bits allow.
SHORTEST, LONGEST = 28, 83
ADDED = ("_n_bytes", "_n_removed", "_n_spans", "_kept_sha256")
CHUNK_BYTES, BUCKET_BYTES = 4 << 20, 16 << 20
#: Triggers in more documents than this are compared string by string, each string once per chunk.
HOT = 4096
LAST = np.iinfo(np.int64).max

_rng = np.random.default_rng(50)
_ODD = _rng.integers(1 << 62, (1 << 63) - 1, 64, dtype=np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= _ODD[60]
    x ^= x >> np.uint64(29)
    return x


def _every(buf: np.ndarray, dtype: str) -> np.ndarray:
    """The value that starts at each byte; ``buf`` ends with spare bytes."""
    return np.ndarray((len(buf) - 8,), dtype, buffer=buf, strides=(1,))


def _sliding(x: np.ndarray, n: int, least) -> np.ndarray:
    """``least`` over x[i:i+n], for every i with n values left."""
    width = 1
    while 2 * width <= n:
        x = least(x[:-width], x[width:])
        width *= 2
    return least(x[: len(x) - (n - width)], x[n - width:]) if n > width else x


class Chunk:
    """The documents of a chunk side by side, in a fixed order."""

    def __init__(self, ids: list, texts: list):
        texts = [t.encode() if isinstance(t, str) else bytes(t or b"") for t in texts]
        ids = [LAST if i is None else int(i) for i in ids]
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        texts = [texts[i] for i in self.order]
        self.ids = np.array([ids[i] for i in self.order], np.int64)
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.pad = 128
        self.bytes = np.frombuffer(bytes(self.pad) + b"".join(texts) + bytes(self.pad), np.uint8)

    def triggers(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, hash, document row) of every trigger."""
        found, row, n = [], 0, len(self.ids)
        while row < n:  # about a megabyte at a time
            stop = max(row + 1, int(np.searchsorted(self.ends, self.starts[row] + (1 << 20), "right")))
            found.append(self._triggers(row, stop, length))
            row = stop
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        place, gram = (np.concatenate(x) for x in zip(*found))
        return place, gram, np.searchsorted(self.ends, place, "right")

    def _triggers(self, row: int, stop: int, length: int):
        low, high = int(self.starts[row]), int(self.ends[stop - 1])
        size, window = high - low, length - GRAM + 1
        if size < length:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        buf = self.bytes[self.pad + low: self.pad + high + 64]
        eight = _every(buf, "<u8")
        hashes = eight[:size] * _ODD[0]
        hashes += eight[8: size + 8] * _ODD[1]
        hashes += _every(buf, "<u4")[16: size + 16] * _ODD[2]
        hashes = _mixed(hashes)
        rank = (hashes >> np.uint64(32)).astype(np.uint32)
        # Only windows inside one document count.
        least = _sliding(rank, window, np.minimum)
        starts, ends = self.starts[row:stop] - low, self.ends[row:stop] - low
        inside = np.zeros(size + 1, np.int32)
        long = ends - starts >= length
        inside[starts[long]] += 1
        inside[(ends - length + 1)[long]] -= 1
        inside = np.cumsum(inside[: len(least)]) > 0
        bound = np.zeros(len(least) + 2 * (window - 1), np.uint32)
        bound[window - 1: window - 1 + len(least)] = np.where(inside, least, 0)
        most = _sliding(bound, window, np.maximum)  # of the windows that hold a place
        place = np.flatnonzero((rank[: len(most)] == most) & (most > 0))
        return place + low, hashes[place]

    def contexts(self, place: np.ndarray, row: np.ndarray, length: int):
        """What a string that holds the trigger can reach: bytes, bytes left of it, bytes from it on; hashes of all that."""
        reach = length - GRAM
        left = np.minimum(place - self.starts[row], reach)
        right = np.minimum(self.ends[row] - place, length)
        width = -(-(reach + length) // 8) * 8
        span = np.arange(width, dtype=np.int64)
        hashed, texts = [], []
        for k in range(0, len(place), 1 << 15):
            p, l, r = (x[k: k + (1 << 15), None] for x in (place, left, right))
            at = span[None, :] - reach
            text = np.where((at >= -l) & (at < r), self.bytes[np.minimum(p + at + self.pad, len(self.bytes) - 1)], 0).astype(np.uint8)
            lanes = text.view("<u8")
            sums = [(lanes * _ODD[b: b + lanes.shape[1]]).sum(1, dtype=np.uint64) + (l * 256 + r)[:, 0].astype(np.uint64) * _ODD[b + 20] for b in (3, 30)]
            hashed.append(np.stack([_mixed(s) for s in sums], 1))
            texts.append(text)
        if not texts:
            return np.zeros((0, width), np.uint8), left, right, np.zeros((0, 2), np.uint64)
        return np.concatenate(texts), left, right, np.concatenate(hashed)


def _first_of(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts by the keys (last is first), and where a new key begins in it."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return order, new


def _local(gram: np.ndarray, row: np.ndarray):
    """Distinct triggers of a chunk, and in how many of its documents each is."""
    order, new = _first_of([row, gram])
    g = gram[order][new]
    heads = np.ones(len(g), bool)
    heads[1:] = g[1:] != g[:-1]
    at = np.flatnonzero(heads)
    return g[at], np.diff(np.append(at, len(g)))


def _dealt(key: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    """Indices by bucket of a hash."""
    bucket = ((key >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    return [(int(bucket[part[0]]), part) for part in np.split(order, cuts[1:])] if len(key) else []


def _packed(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


TRIGGERS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("grams", pa.binary()), ("docs", pa.binary())])
SHARED = pa.schema([("chunk", pa.int32()), ("grams", pa.binary()), ("hot", pa.binary())])
ENTRIES = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("hot", pa.bool_()), ("body", pa.binary())])
ANSWERS = pa.schema([("chunk", pa.int32()), ("body", pa.binary())])
ANSWER = np.dtype([("at", "<i8"), ("mask", "<u8")])
STRING = np.dtype([("a", "<u8"), ("b", "<u8"), ("doc", "<i8"), ("at", "<i8"), ("k", "u1")])
KINDS = {pa.int32(): "int", pa.binary(): "binary", pa.bool_(): "boolean"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {KINDS[f.type]}" for f in schema)


def _entry(length: int) -> np.dtype:
    width = -(-(2 * length - GRAM) // 8) * 8
    return np.dtype([("doc", "<i8"), ("at", "<i8"), ("left", "u1"), ("right", "u1"), ("text", "u1", (width,))])


def _squeezed(rows: np.ndarray) -> bytes:
    """Rows column by column, compressed: contexts are text."""
    return zstandard.compress(b"".join(np.ascontiguousarray(rows[name]).tobytes() for name in rows.dtype.names), 3)


def _unsqueezed(body: bytes, kind: np.dtype) -> np.ndarray:
    body = zstandard.decompress(body)
    rows, at = np.empty(len(body) // kind.itemsize, kind), 0
    for name in kind.names:
        size = kind[name].itemsize * len(rows)
        rows[name] = np.frombuffer(body[at: at + size], kind[name].base).reshape(rows[name].shape)
        at += size
    return rows


def _chunk(table: pa.Table, doc_id: str, text: str) -> Chunk:
    return Chunk(table.column(doc_id).to_pylist(), table.column(text).to_pylist())


def _propose(doc_id: str, text: str, length: int, buckets: int):
    """Triggers of a chunk, dealt by their hash."""

    def run(table: pa.Table) -> pa.Table:
        number = table.column("_chunk")[0].as_py()
        place, gram, row = _chunk(table, doc_id, text).triggers(length)
        g, n = _local(gram, row)
        n = np.minimum(n, 65535).astype("<u2")
        return _packed([(b, number, g[i].tobytes(), n[i].tobytes()) for b, i in _dealt(g, buckets)], TRIGGERS)

    return run


def _meet(hot_docs: int):
    """Triggers of a bucket that several chunks have, for each of these."""
    return lambda table: _met(table, hot_docs)


def _met(table: pa.Table, hot_docs: int) -> pa.Table:
    chunks = table.column("chunk").to_pylist()
    grams = [np.frombuffer(x, "<u8") for x in table.column("grams").to_pylist()]
    docs = np.concatenate([np.frombuffer(x, "<u2") for x in table.column("docs").to_pylist()]).astype(np.int64)
    chunk = np.repeat(np.array(chunks, np.int64), [len(g) for g in grams])
    gram = np.concatenate(grams)
    order, new = _first_of([gram])
    group = np.cumsum(new) - 1
    total = np.bincount(group, docs[order])
    several = np.bincount(group) > 1
    keep = several[group]
    rows, hot = order[keep], total[group][keep] > hot_docs
    by = np.argsort(chunk[rows], kind="stable")
    rows, hot = rows[by], hot[by]
    cuts = np.flatnonzero(np.diff(chunk[rows], prepend=-1))
    return _packed([(int(chunk[part[0]]), gram[part].tobytes(), flag.tobytes())
                    for part, flag in zip(np.split(rows, cuts[1:]), np.split(hot, cuts[1:]))] if len(rows) else [], SHARED)


def _known(sorted_values: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether and where each x is among sorted values."""
    if not len(sorted_values):
        return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x, at


def _distinct(chunk: Chunk, place, row, length: int):
    """Contexts of a chunk: for each distinct one its first occurrence (least document), and each occurrence's context."""
    text, left, right, hashes = chunk.contexts(place, row, length)
    order, new = _first_of([place, hashes[:, 1], hashes[:, 0]])
    same = np.zeros(len(order), bool)
    same[1:] = (hashes[order][1:] == hashes[order][:-1]).all(1)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(~same) - 1
    return text, left, right, order[~same], group


def _describe(doc_id: str, text_name: str, length: int, buckets: int):
    """Contexts of the triggers that other documents have, dealt by trigger; strings where the trigger is hot."""

    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _packed([], ENTRIES)
        number = table.column("_chunk")[0].as_py()
        chunk = _chunk(table, doc_id, text_name)
        place, gram, row = chunk.triggers(length)
        g, n = _local(gram, row)
        shared = np.concatenate([np.zeros(0, "<u8"), *(np.frombuffer(x, "<u8") for x in listed(replies, "grams"))])
        hot = np.concatenate([np.zeros(0, bool), *(np.frombuffer(x, bool) for x in listed(replies, "hot"))])
        order = np.argsort(shared)
        shared, hot = shared[order], hot[order]
        inside, _ = _known(g[n > 1], gram)
        outside, at = _known(shared, gram)
        use = np.flatnonzero(inside | outside)
        very = outside & (hot[at] if len(hot) else False)
        place, gram, row, very = place[use], gram[use], row[use], very[use]
        text, left, right, first, _ = _distinct(chunk, place, row, length)
        rows = []
        cold = first[~very[first]]
        body = np.zeros(len(cold), _entry(length))
        for name, value in (("at", place), ("left", left), ("right", right), ("text", text)):
            body[name] = value[cold]
        body["doc"] = chunk.ids[row[cold]]
        rows += [(b, number, False, _squeezed(body[i])) for b, i in _dealt(gram[cold], buckets)]
        warm = first[very[first]]
        strings = [_strings(text[warm], left[warm], right[warm], gram[warm], chunk.ids[row[warm]], place[warm], k, length) for k in range(length - GRAM + 1)] if len(warm) else []
        if strings:
            body = np.concatenate(strings)
            rows += [(b, number, True, _squeezed(body[i])) for b, i in _dealt(body["a"], buckets)]
        return _packed(rows, ENTRIES)

    return run


def _strings(text, left, right, gram, doc, at, k: int, length: int) -> np.ndarray:
    """The string whose trigger is at byte ``k``, of each context that has it; the least document per string."""
    reach = length - GRAM
    ok = np.flatnonzero((left >= k) & (right >= length - k))
    width = -(-length // 8) * 8
    cut = np.zeros((len(ok), width), np.uint8)
    cut[:, :length] = text[ok, reach - k: reach - k + length]
    lanes = cut.view("<u8")
    out = np.zeros(len(ok), STRING)
    for name, b in (("a", 3), ("b", 30)):
        out[name] = _mixed((lanes * _ODD[b: b + lanes.shape[1]]).sum(1, dtype=np.uint64) + _ODD[b + 20: b + 21] * np.uint64(k))
    out["doc"], out["at"], out["k"] = doc[ok], at[ok], k
    return out


def _ranked(gram: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order by (trigger, text), and the common prefix with the one before (-1 at a new trigger)."""
    width = -(-text.shape[1] // 8) * 8
    wide = np.zeros((len(text), width), np.uint8)
    wide[:, : text.shape[1]] = text
    lanes = wide.view(">u8").astype(np.uint64)
    order = np.lexsort([*(lanes[:, i] for i in range(lanes.shape[1] - 1, -1, -1)), gram])
    common = np.full(len(order), -1, np.int64)
    differs = text[order][1:] != text[order][:-1]
    shared = np.where(differs.any(1), differs.argmax(1), text.shape[1])
    common[1:] = np.where(gram[order][1:] == gram[order][:-1], shared, -1)
    return order, common


def _decide(length: int):
    """Which strings of each context also start in a smaller document."""
    reach = length - GRAM

    def cold(e: np.ndarray) -> np.ndarray:
        mask, n = np.zeros(len(e), np.uint64), len(e)
        parse, parse_common = _ranked(np.zeros(n, np.int64), e["text"][:, reach: reach + length])
        gram = np.empty(n, np.int64)
        gram[parse] = np.cumsum(parse_common < GRAM)
        phrase, phrase_common = _ranked(gram, e["text"][:, :reach][:, ::-1])
        for k in range(reach + 1):
            before, after = np.empty(n, np.int64), np.empty(n, np.int64)
            before[phrase] = np.cumsum(phrase_common < k)
            after[parse] = np.cumsum(parse_common < length - k)
            ok = np.flatnonzero((e["left"] >= k) & (e["right"] >= length - k))
            if not len(ok):
                continue
            key = before[ok] * (n + 1) + after[ok]
            order = np.argsort(key)
            new = np.ones(len(ok), bool)
            new[1:] = key[order][1:] != key[order][:-1]
            doc = e["doc"][ok][order]
            least = np.minimum.reduceat(doc, np.flatnonzero(new))[np.cumsum(new) - 1]
            mask[ok[order[least < doc]]] |= np.uint64(1 << k)
        return mask

    def run(table: pa.Table) -> pa.Table:
        rows = []
        chunks, flags = np.array(table.column("chunk").to_pylist(), np.int64), np.array(table.column("hot").to_pylist(), bool)
        bodies = table.column("body").to_pylist()
        for hot, kind in ((False, _entry(length)), (True, STRING)):
            mine = np.flatnonzero(flags == hot)
            if not len(mine):
                continue
            parts = [_unsqueezed(bodies[i], kind) for i in mine]
            chunk = np.repeat(chunks[mine], [len(p) for p in parts])
            e = np.concatenate(parts)
            if hot:
                order, new = _first_of([e["b"], e["a"]])
                least = np.minimum.reduceat(e["doc"][order], np.flatnonzero(new))[np.cumsum(new) - 1]
                hit = order[least < e["doc"][order]]
                chunk, at, mask = chunk[hit], e["at"][hit], np.uint64(1) << e["k"][hit].astype(np.uint64)
            else:
                mask = cold(e)
                hit = np.flatnonzero(mask)
                chunk, at, mask = chunk[hit], e["at"][hit], mask[hit]
            order = np.argsort(chunk, kind="stable")
            body = np.zeros(len(order), ANSWER)
            body["at"], body["mask"] = at[order], mask[order]
            cuts = np.flatnonzero(np.diff(chunk[order], prepend=-1))
            if len(order):
                rows += [(int(c), part.tobytes()) for c, part in zip(chunk[order][cuts], np.split(body, cuts[1:]))]
        return _packed(rows, ANSWERS)

    return run


def removed(chunk: Chunk, answers: list[bytes], length: int) -> np.ndarray:
    """A flag for every byte of the chunk."""
    place, gram, row = chunk.triggers(length)
    told = np.concatenate([np.zeros(0, ANSWER), *(np.frombuffer(a, ANSWER) for a in answers)])
    g, n = _local(gram, row)
    _, at = _known(place, told["at"])
    inside, _ = _known(g[n > 1], gram)
    outside, _ = _known(np.unique(gram[at]) if len(told) else np.zeros(0, np.uint64), gram)
    use = np.flatnonzero(inside | outside)
    place, row = place[use], row[use]
    _, left, right, first, group = _distinct(chunk, place, row, length)
    masks = np.zeros(len(first), np.uint64)
    if len(told):
        _, at = _known(place, told["at"])
        np.bitwise_or.at(masks, group[at], told["mask"])
    later = chunk.ids[row] > chunk.ids[row[first]][group]
    begins = np.zeros(len(chunk.bytes) - 2 * chunk.pad + 1, np.int64)
    for k in range(length - GRAM + 1):
        valid = (left >= k) & (right >= length - k)
        hit = valid & (later | ((masks[group] >> np.uint64(k)) & np.uint64(1)).astype(bool))
        begins[place[hit] - k] = 1
    seen = np.cumsum(begins[:-1])
    before = np.zeros_like(seen)
    before[length:] = seen[:-length] if len(seen) > length else 0
    return seen > before


def _finish(doc_id: str, text: str, length: int, keep: list[str], with_text: bool, schema: pa.Schema):
    """Removed bytes counted and taken out."""

    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        chunk = _chunk(table, doc_id, text)
        gone = removed(chunk, listed(replies, "body"), length)
        body = chunk.bytes[chunk.pad: len(chunk.bytes) - chunk.pad]
        total = np.concatenate([[0], np.cumsum(gone)])
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        opens[chunk.starts[chunk.lengths > 0]] = gone[chunk.starts[chunk.lengths > 0]]
        spans = np.concatenate([[0], np.cumsum(opens)])
        left = [body[a:b][~gone[a:b]].tobytes() for a, b in zip(chunk.starts, chunk.ends)]
        out = table.select(keep).take(pa.array(chunk.order))
        if with_text:
            null = table.column(text).is_null().to_pylist()
            told = [None if null[i] else b.decode(errors="ignore") for i, b in zip(chunk.order, left)]
            out = out.set_column(keep.index(text), schema.field(text), pa.array(told, schema.field(text).type))
        for name, value in (("n_bytes", chunk.lengths), ("n_removed", total[chunk.ends] - total[chunk.starts]), ("n_spans", spans[chunk.ends] - spans[chunk.starts])):
            out = out.append_column(f"_{name}", pa.array(value.astype(np.int64)))
        return out.append_column("_kept_sha256", pa.array([hashlib.sha256(b).hexdigest() for b in left])).cast(schema)

    return run


def deduplicated(docs: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None,
                 with_text: bool = True, hot: int = HOT) -> DataFrame:
    """Columns ``keep`` of every document, ``text`` without the removed bytes, and what was removed:
    ``_n_bytes``, ``_n_removed``, ``_n_spans``, ``_kept_sha256`` (of the remaining bytes).

    A byte goes if a string of ``length`` bytes (28 to 83) over it also starts in a
    document with a smaller id.  Null texts are empty (and stay null), texts
    shorter than ``length`` are left alone, a null id counts as larger than any
    other, and rows of one id take nothing from each other.  A character cut
    in two is dropped from the text; the digest is of the bytes.  A kept column
    with the name of a result raises; ``cleaned`` takes any names.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    if not SHORTEST <= length <= LONGEST:
        raise ValueError(f"length must be {SHORTEST} to {LONGEST} bytes, not {length}")
    keep = list(keep or docs.columns)
    unclashing(keep, ADDED)
    columns = list(dict.fromkeys([*keep, doc_id, text]))
    inner = {c: f"c{i}" for i, c in enumerate(columns)}
    total, spark = bytes_of(docs, text), docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(math.ceil(total / CHUNK_BYTES), min(tasks, math.ceil(total / (1 << 18))), 1)
    buckets = max(math.ceil(total / BUCKET_BYTES), min(tasks, math.ceil(total / (1 << 18))), 1)
    # Names of their own for the columns: none clashes with ``_chunk``.  Rows without an id are spread by their text.
    spread = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.xxhash64(F.col(f"`{text}`")))
    body = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()], F.pmod(F.xxhash64(spread, F.lit(10)), F.lit(chunks)).cast("int").alias("_chunk"))
    doc_id, text, told = inner[doc_id], inner[text], keep
    keep = [inner[c] for c in keep]
    by_chunk = body.groupBy("_chunk")
    found = by_chunk.applyInArrow(_propose(doc_id, text, length, buckets), _ddl(TRIGGERS))
    shared = found.groupBy("bucket").applyInArrow(_meet(hot), _ddl(SHARED))
    entries = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(_describe(doc_id, text, length, buckets), _ddl(ENTRIES))
    answers = entries.groupBy("bucket").applyInArrow(_decide(length), _ddl(ANSWERS))
    out = body.select(*keep).withColumns({
        "_n_bytes": F.lit(0).cast("long"), "_n_removed": F.lit(0).cast("long"), "_n_spans": F.lit(0).cast("long"), "_kept_sha256": F.lit("")}).schema
    for field in out:
        field.nullable = True
    arrow = to_arrow_schema(out)
    done = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(_finish(doc_id, text, length, keep, with_text, arrow), out)
    return done.toDF(*told, *ADDED)


def cleaned(docs: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with their columns, whatever their names, and the remaining text; see ``deduplicated``."""
    inner, of, back = sealed(docs)
    return back(deduplicated(inner, length, of[doc_id], of[text]))
