"""Packing token sequences by non-negative least squares.

A document's tokens are cut into full windows, one piece of whole units (64
tokens) and a tail shorter than a unit.  The histogram of unit pieces is
matched by repeat counts of shallow combinations (up to three lengths that
fill a window), solved by non-negative least squares and rounded; what rounding
leaves over is packed greedily, largest first, and the room left there, then
further windows, take the tails, cut where a window ends.

Only the histogram (one number per length) meets on the driver.  A piece finds
its window by its rank among the pieces of its length; ranks come from counters
kept by the tokenizing tasks plus the totals of the tasks before, so a length
that most pieces share is never sorted or gathered.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import zlib
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from terraloom.llm.common import saved

WINDOW, UNIT, END_ID = 4096, 64, 2
#: Words of a generation that a task remembers the ids of.
REMEMBERED = 200_000
#: Documents whose new words are learnt together.
AT_ONCE = 256

_ASCII_BLANKS = re.compile("[ \t\n\r\x0b\x0c]+")


# What a tokenizer file must say for its words to be taken apart here.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PIECE_RUN = regex.compile(r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_END_OF_WORD = "</w>"
_BEYOND = re.compile("[^\x00-\xff]")


def _by_words(spec: dict) -> bool:
    """Whether a file lower-cases, drops white space and splits words as ``Encoder`` does."""
    steps, parts, model = (spec.get("normalizer") or {}).get("normalizers"), (spec.get("pre_tokenizer") or {}).get("pretokenizers"), spec["model"]
    return bool(
        steps and parts and [n["type"] for n in steps] == ["NFC", "Replace", "Lowercase"]
        and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
        and [p["type"] for p in parts] == ["Split", "ByteLevel"] and parts[0]["pattern"] == {"Regex": _SPLIT}
        and parts[0]["behavior"] == "Removed" and parts[0]["invert"] and not parts[1]["use_regex"] and not parts[1]["add_prefix_space"]
        and model["type"] == "BPE" and model.get("end_of_word_suffix") == _END_OF_WORD and not model.get("dropout")
        and not model.get("continuing_subword_prefix") and not spec.get("post_processor")
        and all(a["special"] and not a["normalized"] and not a["lstrip"] and not a["rstrip"] and "<|" in a["content"] and a["content"].islower() for a in spec["added_tokens"]))


class Encoder:
    """Token ids of texts.

    A file that lower-cases, drops white space and never joins across it (see
    ``_by_words``, checked when it is opened) is used word by word: words met
    lately, and the pieces that they are made of, are remembered in two
    generations, so that frequent ones stay and memory is bounded.  With any
    other file whole texts go through the tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        with open(path, encoding="utf-8") as file:
            self.by_words = _by_words(json.load(file))
        self.tokenizer, self.known, self.older = Tokenizer.from_file(path), {}, {}
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if not self.by_words:
            return
        # The same model without its rules for text: pieces go in as they are spelt, many in one string.
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = WhitespaceSplit()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith(_END_OF_WORD)]] = True
        # Byte-level vocabularies spell a byte as a printable character: those without one come from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spelt = {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(x for x in range(256) if x not in printable)}
        self.letters = {c: "".join(spelt[b] for b in chr(c).encode()) for c in range(256) if c != 32}

    @staticmethod
    def words(text: str) -> list[str]:
        # str.split also splits at four control characters that are no white space to the tokenizer.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [w for w in _ASCII_BLANKS.split(text) if w]
        return text.split()

    def _learn(self, words: set[str], western: bool) -> None:
        """Ids of new words, lower-cased western ones or any.

        Western letters, digits and marks are pieces for the model as the split
        pattern cuts them, and a piece is a word too, with the same ids; words with
        apostrophes, which may be cut otherwise, added tokens or other scripts go
        through the whole tokenizer.
        """
        known, older, new, cut, rest = self.known, self.older, set(), [], []
        for word in words:
            ids = older.get(word)
            if ids is not None:
                known[word] = ids
                continue
            low = word
            if not western:
                low = word.lower()
                if not low.isascii() and max(low) > "\xff":
                    rest.append(word)
                    continue
            if low.isalpha():
                if western:
                    new.add(word)
                else:
                    cut.append((word, (low,)))
            elif low[-1] in ".,!?;:" and low[:-1].isalpha():
                cut.append((word, (low[:-1], low[-1])))
            elif "'" not in low and "<|" not in low and len(word) < 1000:
                cut.append((word, _PIECE_RUN.findall(low)))
            else:
                rest.append(word)
        for _, pieces in cut:
            for piece in pieces:
                if piece not in known:
                    ids = older.get(piece)
                    if ids is None:
                        new.add(piece)
                    else:
                        known[piece] = ids
        if new:  # all in one string, parted again where the model ends a word
            order = list(new)
            got = np.array(self.bare.encode_batch_fast([" ".join(order).translate(self.letters)], add_special_tokens=False)[0].ids, "<u4")
            ends, raw = (4 * (np.flatnonzero(self.ends[got]) + 1)).tolist(), got.tobytes()
            known.update((piece, raw[start:end]) for piece, start, end in zip(order, [0, *ends], ends))
        known.update([(word, b"".join([known[p] for p in pieces])) for word, pieces in cut])
        for word, got in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else ()):
            known[word] = struct.pack(f"<{len(got.ids)}I", *got.ids)

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        if not self.by_words:
            return [np.array(g.ids, "<u4").tobytes() for g in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        western = ["<|" not in t and not _BEYOND.search(t) for t in texts]
        # Lower-casing is the same letter by letter there, and fewer words differ afterwards.
        split = [self.words(t.lower() if w else t) for t, w in zip(texts, western)]
        found = [list(map(self.known.get, words)) for words in split]
        missing = [[k for k, ids in enumerate(got) if ids is None] if None in got else [] for got in found]
        for kind in (True, False):
            new = {words[k] for words, places, w in zip(split, missing, western) if w is kind for k in places}
            if new:
                self._learn(new, kind)
        for words, got, places in zip(split, found, missing):
            for k in places:
                got[k] = self.known[words[k]]
        return [b"".join(got) for got in found]


@functools.lru_cache(maxsize=2)
def encoder_for(path: str) -> Encoder:
    """The encoder of this Python worker: later tasks find what earlier ones learnt."""
    return Encoder(path)


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, _class int, _task int, _rank long, _tail binary"
_PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("_class", pa.int32()), ("_task", pa.int32()), ("_rank", pa.int64()), ("_tail", pa.binary())])


def _tokenized(path: str, window: int, unit: int):
    """Pieces of every document.  ``_class``: whole units, 0 for a tail.  ``_rank``: the piece's number among
    those of its class in this task; for a tail the tokens of the tails before it."""

    def run(batches):
        encoder = encoder_for(path)
        task, counts = TaskContext.get().partitionId(), [0] * (window // unit + 1)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(docs), AT_ONCE):
                rows = []
                some = [t or "" for t in texts.slice(at, AT_ONCE).to_pylist()]
                for doc, ids in zip(docs[at: at + AT_ONCE], encoder.ids(some)):
                    ids += end
                    total, start = len(ids) // 4, 0
                    while start < total:
                        length = min(window, (total - start) // unit * unit) or total - start
                        body = ids[4 * start: 4 * (start + length)]
                        kind = length // unit
                        rows.append((doc, start, length, zlib.crc32(body), total, kind, task, counts[kind], None if kind else body))
                        counts[kind] += 1 if kind else length
                        start += length
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECE)], schema=_PIECE)

    return run


def combinations(units: int, depth: int = 3) -> list[tuple[int, ...]]:
    """Lengths, longest first, that fill a window of ``units``: at most ``depth`` of them, at least two."""
    return [
        tuple(sorted((*some, units - sum(some)), reverse=True))
        for n in range(1, depth) for some in combinations_with_replacement(range(1, units), n)
        if units - sum(some) >= some[-1]
    ]


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """x >= 0 with least |a x - b|, by the active-set method."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    slope = a.T @ (b - a @ x)
    limit = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(rounds):
        rest = np.where(free, -np.inf, slope)
        enter = int(rest.argmax())
        if free.all() or rest[enter] <= limit:
            break
        free[enter] = True
        while True:
            s = np.zeros_like(x)
            s[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            low = free & (s <= 0)
            if not low.any():
                break
            if low[enter] and x[enter] == 0 and low.sum() == 1 and s[enter] <= 0 and not (x[free] > 0).any():
                free[enter] = False
                s = x.copy()
                break
            step = (x[low] / np.maximum(x[low] - s[low], 1e-300)).min()
            x += step * (s - x)
            free &= x > 1e-12
            x[~free] = 0
        x = s
        slope = a.T @ (b - a @ x)
        slope[free] = 0
    return x


def patterns(histogram: list[int], units: int, depth: int = 3) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a window in units, how often): every piece of ``histogram`` (count by length) used exactly once."""
    left = np.array(histogram, np.int64)
    combos = combinations(units, depth)
    use = np.zeros((units, len(combos)))
    for j, combo in enumerate(combos):
        for u in combo:
            use[u, j] += 1
    # Long pieces are hard to place later: their rows weigh more.
    weight = np.sqrt(np.arange(units) + 1.0)[:, None]
    repeats = np.floor(nnls(weight * use, weight[:, 0] * left[:units]) + 1e-6).astype(np.int64)
    out = [((units,), int(left[units]))] if left[units] else []
    left[units] = 0
    for j in np.argsort(-repeats, kind="stable"):
        need = use[:, j].astype(np.int64)
        n = min(int(repeats[j]), *(int(left[u] // need[u]) for u in set(combos[j])))
        if n > 0:
            out.append((combos[j], n))
            left[:units] -= n * need
    while left.any():  # greedily: the longest that fits, the same window as often as it goes
        room, pattern, taken = units, [], np.zeros_like(left)
        for u in range(units - 1, 0, -1):
            n = int(min(left[u], room // u))
            pattern += [u] * n
            taken[u], room = n, room - n * u
        n = int((left[taken > 0] // taken[taken > 0]).min())
        out.append((tuple(pattern), n))
        left -= n * taken
    return out


def plan(histogram: list[int], units: int, unit: int, depth: int = 3):
    """Where the ranks of each length go, and the rooms the tails take.

    Returns ({length: (first ranks, first window, offset)}, [(first tail token, first window, room)]).
    """
    used, window, at = [0] * (units + 1), 0, 0
    places: dict[int, list[tuple[int, int, int]]] = {}
    rooms: list[tuple[int, int, int]] = []
    for pattern, n in patterns(histogram, units, depth):
        offset = 0
        for u in pattern:
            places.setdefault(u, []).append((used[u], window, offset * unit))
            used[u] += n
            offset += u
        if offset < units:
            rooms.append((at, window, (units - offset) * unit))
            at += n * (units - offset) * unit
        window += n
    rooms.append((at, window, units * unit))
    return {u: np.array(v, np.int64) for u, v in places.items()}, np.array(rooms, np.int64)


PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_PACKED = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def _placed(places: dict[int, np.ndarray], rooms: np.ndarray, window: int):
    def tails(batch: pa.RecordBatch, at: np.ndarray):
        """Windows and offsets of tails; a tail is cut where its room ends."""
        out, at, length = [], at.copy(), batch.column("length").to_numpy().copy()
        skip = np.zeros(len(at), np.int64)
        rows = np.arange(len(at))
        while len(rows):
            room = rooms[np.searchsorted(rooms[:, 0], at[rows], "right") - 1]
            inside = at[rows] - room[:, 0]
            take = np.minimum(length[rows], room[:, 2] - inside % room[:, 2])
            out.append((rows, skip[rows], take, room[:, 1] + inside // room[:, 2], window - room[:, 2] + inside % room[:, 2]))
            at[rows] += take
            skip[rows] += take
            length[rows] -= take
            rows = rows[length[rows] > 0]
        rows, skip, take, sequence, offset = (np.concatenate(x) for x in zip(*out))
        body = batch.column("_tail").to_pylist()
        crc = [zlib.crc32(body[r][4 * s: 4 * (s + n)]) for r, s, n in zip(rows, skip, take)]
        got = batch.take(pa.array(rows))
        return [got.column("doc_id"), got.column("start").to_numpy() + skip, take, crc, got.column("doc_tokens"), sequence, offset]

    def run(batches):
        # Ids stay in Arrow: next to a null one, pandas would make them floating.
        for batch in batches:
            rank = batch.column("_rank").to_numpy() + batch.column("_before").to_numpy()
            kinds = batch.column("_class").to_numpy()
            for kind in np.unique(kinds).tolist():
                rows = np.flatnonzero(kinds == kind)
                part = batch.take(pa.array(rows))
                if kind == 0:
                    columns = tails(part, rank[rows])
                else:
                    p = places[kind]
                    hit = p[np.searchsorted(p[:, 0], rank[rows], "right") - 1]
                    columns = [*(part.column(n) for n in _PACKED.names[:5]), hit[:, 1] + rank[rows] - hit[:, 0], hit[:, 2]]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], schema=_PACKED)

    return run


def packed(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, unit: int = UNIT,
           depth: int = 3) -> DataFrame:
    """Every token of every document in exactly one piece of one window: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer``: path of a tokenizer file, there on every machine; the end id
    is added to each document.  Null and empty texts are
    one token, null ids stay null, repeated rows are packed each, an empty table
    gives no rows; extra columns are not read.
    """
    units = window // unit
    bare = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    pieces = saved(bare.mapInArrow(_tokenized(tokenizer, window, unit), PIECE), "pieces")
    # One row per task and length; then one number per length for the driver.
    sizes = pieces.groupBy("_task", "_class").agg(F.count(F.lit(1)).alias("_pieces"), F.sum("length").alias("_tokens"))
    histogram = [0] * (units + 1)
    for r in sizes.filter("_class > 0").groupBy("_class").agg(F.sum("_pieces").alias("n")).collect():
        histogram[r["_class"]] = r["n"]
    places, rooms = plan(histogram, units, unit, depth)
    earlier = Window.partitionBy("_class").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        "_task", "_class",
        F.coalesce(F.sum(F.when(F.col("_class") > 0, F.col("_pieces")).otherwise(F.col("_tokens"))).over(earlier), F.lit(0)).alias("_before"))
    return pieces.join(before, ["_task", "_class"]).mapInArrow(_placed(places, rooms, window), PACKED)
