"""Byte-level BPE of whole texts by tree concatenation, and back to text.

A long text is cut into halves, again and again, at whatever place is the
middle.  Tasks encode the halves independently; a tree of joins then puts them
together.  Near a join the tokens of both sides may be wrong, so a window
around it is encoded anew and grows until it agrees with both sides:

* Boundaries of pre-tokens depend only on what follows them and, as the pattern
  looks three characters ahead at most, on nothing further.  A window that
  starts at a settled boundary of the left side and meets a boundary of the
  right side again has the true pre-tokens in between.
* Inside one long pre-token (no boundary near) the window is counted in tokens.
  A sequence of tokens is the encoding of its text if each two neighbours are
  the encoding of theirs, so it is done once the window's first token is the
  left side's and its last the right side's.

Tokens beyond the windows are never encoded twice.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from terraloom.llm.common import saved

#: Characters of a leaf; longer texts are halved.
LEAF = 16_384
#: Characters without a sure boundary from which pre-tokens are looked at one by one.
UNSPLIT = 256
#: Chunks of a generation that a worker remembers the ids of, and their greatest length.
REMEMBERED, SHORT = 200_000, 64
#: Boundaries kept at each end of a part, and characters of text there.
EDGES, EDGE = 32, 1024
MARKS = frozenset(".,!?;:")
#: Texts whose new chunks are learnt together.
AT_ONCE = 1024
#: Characters that the pre-token pattern can look ahead.
AHEAD = 3

# Unicode's White_Space characters.
SPACE = " \t\n\r\x0b\x0c\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A pre-token never goes on from another character into white space.
_CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


# Fixed value: the pre-token pattern of byte-level files.
_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_BEYOND = re.compile("[^\x00-\xff]")


class Part:
    """An encoded stretch of text: its ids, and pre-token boundaries near both ends.

    ``bounds`` are places (characters), ``at`` the token numbers there; the first
    and the last EDGES of them are kept.  ``head`` and ``tail`` are the text as far
    as joins may need it: all of it, or stretches at the ends with so many sure
    boundaries that a window closes inside.
    """

    __slots__ = ("length", "head", "tail", "ids", "bounds", "at")

    def __init__(self, length: int, head: str, tail: str, ids: np.ndarray, bounds: np.ndarray, at: np.ndarray):
        if len(bounds) > 2 * EDGES:
            bounds, at = (np.concatenate([x[:EDGES], x[-EDGES:]]) for x in (bounds, at))
        self.length, self.head, self.tail, self.ids, self.bounds, self.at = length, head, tail, ids, bounds, at


class Encoder:
    """Ids as the tokenizer file gives them, by chunks that no pre-token crosses."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, added, model = spec["pre_tokenizer"] or {}, spec["added_tokens"], spec["model"]
        plain = (model["type"] == "BPE" and not spec["normalizer"] and not spec["post_processor"] and not model.get("dropout")
                 and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix") and not model.get("ignore_merges")
                 and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                 and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or re.search(f"[{SPACE}]", a["content"])
                         or a["content"].strip("".join(MARKS)).isalpha() for a in added))
        if not plain:
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.pre = self.tokenizer.model, self.tokenizer.pre_tokenizer
        # The same model without its rules for text: pre-tokens go in as they are spelt, many in one string.
        self.bare = Tokenizer(self.model)
        self.bare.pre_tokenizer = WhitespaceSplit()
        self.special = re.compile("|".join(re.escape(a["content"]) for a in added) or r"(?!)")
        self.known, self.older = {}, {}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.spelt = [""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.spelt[i] = token
        self.lengths = np.array([len(s) for s in self.spelt])
        # Byte-level vocabularies spell a byte as a printable character: those without one come from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {b: b for b in printable} | {b: 256 + n for n, b in enumerate(x for x in range(256) if x not in printable)}
        back = {chr(c): b for b, c in letters.items()}
        self.bytes = [bytes(back[c] for c in s) if all(c in back for c in s) else s.encode() for s in self.spelt]
        self.letters = {c: "".join(chr(letters[b]) for b in chr(c).encode()) for c in range(256)}

    def _western(self, text: str) -> bool:
        """Whether the pattern can be used here: one byte's worth of characters, no added token."""
        return not _BEYOND.search(text) and not self.special.search(text)

    def _learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of new chunks: short ones are remembered, those of long ones returned.

        A chunk of western letters, with a space before or a mark behind, is a
        pre-token (or two); others are cut by the pattern, and chunks with added
        tokens or other scripts go through the whole tokenizer.  A pre-token is a
        chunk too, with the same ids.
        """
        known, older, new, cut, rest, once = self.known, self.older, set(), [], [], {}
        for chunk in chunks:
            ids = older.get(chunk)
            if ids is not None:
                known[chunk] = ids
                continue
            if not chunk.isascii() and _BEYOND.search(chunk):
                rest.append(chunk)
                continue
            body = chunk[1:] if chunk[0] == " " else chunk
            if body.isalpha():
                new.add(chunk)
            elif body[-1:] in MARKS and body[:-1].isalpha():
                cut.append((chunk, (chunk[:-1], chunk[-1])))
            elif self.special.search(chunk):
                rest.append(chunk)
            else:
                cut.append((chunk, _PATTERN.findall(chunk)))
        for _, pieces in cut:
            for piece in pieces:
                if piece not in known:
                    ids = older.get(piece)
                    if ids is None:
                        new.add(piece)
                    else:
                        known[piece] = ids
        if new:  # all in one string, parted again by the lengths that their tokens spell
            order = list(new)
            spelt = [p.translate(self.letters) for p in order]
            got = np.array(self.bare.encode_batch_fast([" ".join(spelt)], add_special_tokens=False)[0].ids, "<i4")
            ends = np.searchsorted(np.cumsum(self.lengths[got]), np.cumsum(list(map(len, spelt))))
            raw, stops = got.tobytes(), (4 * (ends + 1)).tolist()
            known.update((piece, raw[start:end]) for piece, start, end in zip(order, [0, *stops], stops))
        known.update([(chunk, b"".join([known[p] for p in pieces])) for chunk, pieces in cut])
        for chunk, got in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else ()):
            known[chunk] = np.array(got.ids, "<i4").tobytes()
        for chunk in {c for c in (*new, *rest, *(c for c, _ in cut)) if len(c) > SHORT}:
            once[chunk] = known.pop(chunk)
        return once

    def _ids(self, lists: list[list[str]]) -> list[list[bytes]]:
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        found = [list(map(self.known.get, chunks)) for chunks in lists]
        missing = [[k for k, ids in enumerate(got) if ids is None] if None in got else [] for got in found]
        new = {chunks[k] for chunks, places in zip(lists, missing) for k in places}
        once = self._learn(new) if new else {}
        for chunks, got, places in zip(lists, found, missing):
            for k in places:
                ids = self.known.get(chunks[k])
                got[k] = once[chunks[k]] if ids is None else ids
        return found

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of short texts as little-endian 32-bit numbers."""
        return [b"".join(got) for got in self._ids([_CHUNK.findall(t) for t in texts])]

    def pretokens(self, text: str) -> list[str]:
        """The pre-tokens of a text; an added token is one."""
        if self._western(text):
            return _PATTERN.findall(text)
        out, at = [], 0
        for hit in [*self.special.finditer(text), None]:
            upto = hit.start() if hit else len(text)
            out += [text[at + a: at + b] for _, (a, b) in self.pre.pre_tokenize_str(text[at:upto])]
            if hit:
                out.append(hit.group())
                at = hit.end()
        return out

    def parts(self, texts: list[str]) -> list[Part]:
        """Stretches of text, each encoded on its own."""
        cut = []
        for text in texts:
            chunks = _CHUNK.findall(text)
            if len(chunks) * UNSPLIT < len(text) or len(max(chunks, key=len, default="")) > UNSPLIT:
                chunks = [p for c in chunks for p in (self.pretokens(c) if len(c) > UNSPLIT else (c,))]
            cut.append(chunks)
        out = []
        start = lambda x: np.cumsum([0, *x], dtype=np.int64)[:-1]
        for text, pieces, got in zip(texts, cut, self._ids(cut)):
            # With enough sure boundaries in it, the stretch at an end is all that a window there can need.
            edges = text[:EDGE], text[-EDGE:]
            if len(text) <= 2 * EDGE or any(len(_CHUNK.findall(e)) < 8 or len(max(_CHUNK.findall(e), key=len)) > EDGE // 4 for e in edges):
                edges = text, text
            out.append(Part(len(text), *edges, np.frombuffer(b"".join(got), "<i4"), start(map(len, pieces)), start(len(g) // 4 for g in got)))
        return out

    def spliced(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The encoding of one pre-token from those of two parts of it."""
        k = 1
        while True:
            a, b = min(k, len(left)), min(k, len(right))
            window = "".join(self.spelt[i] for i in (*left[len(left) - a:], *right[:b]))
            ids = [t.id for t in self.model.tokenize(window)]
            agree_left = a == len(left) or ids[0] == left[len(left) - a]
            agree_right = b == len(right) or ids[-1] == right[b - 1]
            if agree_left and agree_right:
                return np.concatenate([left[: len(left) - a], np.array(ids, "<i4"), right[b:]])
            k *= 2

    def joined(self, a: Part, b: Part) -> Part:
        """Two neighbouring parts as one."""
        if not a.length or not b.length:
            return a if a.length else b
        # The last boundary of the left side that what follows cannot move; 0 always is one.
        i = max(int(np.searchsorted(a.bounds, a.length - AHEAD, "right")) - 1, 0)
        s, tail = int(a.bounds[i]), a.length - int(a.bounds[i])
        left = a.tail[len(a.tail) - tail:]
        reach = max(32, tail)
        while True:
            reach = min(reach, len(b.head))
            pieces = self.pretokens(left + b.head[:reach])
            ends = np.cumsum([len(p) for p in pieces]) - tail
            # A boundary of the window is settled if the window shows all that the pattern could see behind it.
            settled = ends[(ends >= 0) & ((ends <= reach - AHEAD) | (reach == b.length))]
            meet = settled[np.isin(settled, b.bounds) | (settled == b.length)]
            if len(meet):
                break
            reach *= 2
        p = int(meet[0])
        j = int(np.searchsorted(b.bounds, p))
        upto = int(b.at[j]) if j < len(b.at) else len(b.ids)
        pieces = pieces[: int(np.searchsorted(ends, p, "right"))]
        if len(pieces) == 1 and i == len(a.bounds) - 1 and j == 1 and len(pieces[0]) > UNSPLIT:
            got = [self.spliced(a.ids[a.at[i]:], b.ids[:upto])]
        else:
            got = [np.frombuffer(x, "<i4") for x in self._ids([pieces])[0]]
        lengths, counts = [len(x) for x in pieces], [len(g) for g in got]
        first, base = int(a.at[i]), int(a.at[i]) + sum(counts)
        bounds = [a.bounds[:i], s + np.cumsum([0, *lengths], dtype=np.int64)[:-1], b.bounds[j:] + a.length]
        at = [a.at[:i], first + np.cumsum([0, *counts], dtype=np.int64)[:-1], b.at[j:] - upto + base]
        head = a.head + b.head if len(a.head) == a.length else a.head
        tail = a.tail + b.tail if len(b.tail) == b.length else b.tail
        return Part(a.length + b.length, head, tail, np.concatenate([a.ids[:first], *got, b.ids[upto:]]), np.concatenate(bounds), np.concatenate(at))

    def cuts(self, text: str, leaf: int) -> list[str]:
        """A text halved until no part is longer than ``leaf``; no cut lies inside an added token."""
        if len(text) <= leaf:
            return [text]
        middle = len(text) // 2
        for hit in self.special.finditer(text, max(0, middle - 1000), middle + 1000):
            if hit.start() < middle < hit.end():
                middle = hit.start() or hit.end()
        if not 0 < middle < len(text):
            return [text]
        return self.cuts(text[:middle], leaf) + self.cuts(text[middle:], leaf)

    def tree(self, parts: list[Part]) -> Part:
        """All parts of a text, joined by pairs, level by level."""
        while len(parts) > 1:
            parts = [self.joined(*parts[k: k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
        return parts[0]

    def text(self, ids) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def encoder_for(path: str) -> Encoder:
    """The encoder of this Python worker."""
    return Encoder(path)


_LIST = pa.list_(pa.int32())


def _lists(ids: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4"))).cast(_LIST)


def _short(path: str):
    def run(batches):
        encoder = encoder_for(path)
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                docs, texts = batch.column(0).slice(at, AT_ONCE), batch.column(1).slice(at, AT_ONCE)
                yield pa.RecordBatch.from_arrays([docs, _lists(encoder.ids([t or "" for t in texts.to_pylist()]))], names=["doc_id", "ids"])

    return run


def _halved(path: str, leaf: int):
    def run(batches):
        encoder, key = encoder_for(path), TaskContext.get().partitionId() << 33
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                parts = encoder.cuts(text.as_py(), leaf)
                n = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc.as_py()] * n, pa.int64()), pa.array([key] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(parts, pa.string())],
                    names=["doc_id", "_key", "_leaf", "_text"])
                key += 1

    return run


_PART = "length long, head string, tail string, ids binary, bounds binary, at binary"


def _leaves(path: str):
    def run(batches):
        encoder = encoder_for(path)
        kind = "<u2" if len(encoder.spelt) <= 1 << 16 else "<i4"
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                parts = encoder.parts(some.column("_text").to_pylist())
                # Text that is all there goes once.
                columns = [pa.array([p.length for p in parts], pa.int64()), pa.array([p.head for p in parts], pa.string()),
                           pa.array([None if len(p.tail) == p.length else p.tail for p in parts], pa.string())]
                columns += [pa.array([x.astype(t).tobytes() for x in xs], pa.binary()) for t, xs in
                            ((kind, [p.ids for p in parts]), ("<i4", [p.bounds for p in parts]), ("<i4", [p.at for p in parts]))]
                names = ["doc_id", "_key", "_leaf"]
                yield pa.RecordBatch.from_arrays([*map(some.column, names), *columns], names=[*names, "length", "head", "tail", "ids", "bounds", "at"])

    return run


def _concatenated(path: str):
    def run(table: pa.Table) -> pa.Table:
        encoder = encoder_for(path)
        kind = "<u2" if len(encoder.spelt) <= 1 << 16 else "<i4"
        rows = sorted(table.to_pylist(), key=lambda r: r["_leaf"])
        read = lambda r, name, t: np.frombuffer(r[name], t).astype(np.int32 if name == "ids" else np.int64)
        whole = encoder.tree([Part(r["length"], r["head"], r["head"] if r["tail"] is None else r["tail"], read(r, "ids", kind),
                                   read(r, "bounds", "<i4"), read(r, "at", "<i4")) for r in rows])
        return pa.table({"doc_id": pa.array([rows[0]["doc_id"]], pa.int64()), "ids": _lists([np.ascontiguousarray(whole.ids, "<i4").tobytes()])})

    return run


def encoded(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", leaf: int = LEAF) -> DataFrame:
    """``doc_id, ids``: the tokens of every whole text, one row per row.

    ``tokenizer``: path of a byte-level BPE file, there on every machine; others
    raise.  No ids are added; added tokens in a text become their ids, as the
    file says.  Texts up to ``leaf`` characters are a leaf of their own and are
    not shuffled; leaves of longer ones are spread over tasks, and one task
    joins those of a text, which is no more than its row holds.  Null and empty
    texts have no tokens, null ids stay null, repeated rows are encoded each, an
    empty table gives no rows; extra columns are not read.
    """
    bare = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    long = F.coalesce(F.length("_text"), F.lit(0)) > leaf
    short = bare.filter(~long).mapInArrow(_short(tokenizer), "doc_id long, ids array<int>")
    # The key of a text comes from its task: written once, so that all its leaves have the same.
    leaves = saved(bare.filter(long).mapInArrow(_halved(tokenizer, leaf), "doc_id long, _key long, _leaf int, _text string"), "leaves")
    parts = leaves.repartition("_key", "_leaf").mapInArrow(
        _leaves(tokenizer), f"doc_id long, _key long, _leaf int, {_PART}")
    return short.unionByName(parts.groupBy("_key").applyInArrow(_concatenated(tokenizer), "doc_id long, ids array<int>"))


def _decoded(path: str):
    def run(batches):
        encoder = encoder_for(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids = some.column("ids")
                # Whole arrays: list elements one by one cost more than the decoding.
                cells, ends, there = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False)
                texts = [encoder.text(cells[ends[k]:ends[k + 1]].tolist()) if there[k] else None for k in range(len(ids))]
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("ids"), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return run


def decoded(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids, text``: the text of each row's ids, special ones included; null ids have a null text."""
    return tokens.select("doc_id", "ids").mapInArrow(_decoded(tokenizer), "doc_id long, ids array<int>, text string")


def ids_digest(ids: str | Column) -> Column:
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(F.col(ids) if isinstance(ids, str) else ids, ","), 256)
