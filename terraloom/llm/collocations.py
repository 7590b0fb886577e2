"""Collocations by multikey three-way quicksort of suffix pointers.

A first pass counts words.  Words that are too rare end a suffix, as no longer
phrase with them can be frequent.  The suffixes (up to ``longest`` words) are
routed by all their leading words: a sample gives splitters, and each task gets
a range of suffixes in order, however frequent a first word is; equal suffixes
of a batch travel as one with a count.

A task sorts its pointers by three-way partitions, word after word: the size of
an equal partition is the count of its phrase, and partitions smaller than the
limit are abandoned.  Only the phrases at the two ends of a range may go on in
the next one; these few are handed on whatever their count, and summed.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from terraloom.llm.common import A_TO_Z, saved

# Fixed values of the contract: A-Z, the ends of pieces (a dot each) and the separators of words (a space each).
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(A_TO_Z.encode() + _ENDS + b"\t", A_TO_Z.lower().encode() + b"." * len(_ENDS) + b" ")

#: Distinct words that a counting task holds before it hands counts on, and that a worker remembers keys of.
HELD, REMEMBERED = 300_000, 500_000
#: Words in a batch of suffixes, and suffixes in a range on average.
BATCH = RANGE = 1 << 20
#: Frequent words up to which their keys (8 bytes each) go to every task; beyond, rare words end no suffix.
SENT = 4_000_000
#: Ranges at most, sampled suffixes per range and sampled texts.
RANGES, PER_RANGE, SAMPLED = 1 << 16, 16, 4000

END = 0  # the place of a word that is not there


def _words(text: str | None) -> list[bytes]:
    """Words of a text, with a dot between pieces."""
    return (text or "").encode().translate(_TABLE).replace(b".", b" . ").split()


def _key(lang: bytes, word: bytes, seed: int) -> int:
    """A positive 63-bit key of a word of a language."""
    h = hashlib.blake2b(lang + b"\0" + word, digest_size=8, salt=seed.to_bytes(8, "little")).digest()
    return (int.from_bytes(h, "little") >> 1) or 1


def _counted(held: int, seed: int):
    """(lang, word, _key, n) of a task's texts."""

    def run(batches):
        counts: dict[bytes, Counter] = {}

        def out():
            for lang, words in counts.items():
                words.pop(b".", None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang.decode()] * len(words), pa.string()), pa.array([w.decode() for w in words], pa.string()),
                     pa.array([_key(lang, w, seed) for w in words], pa.int64()), pa.array(list(words.values()), pa.int64())],
                    names=["lang", "word", "_key", "n"])
            counts.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts.setdefault(lang.encode(), Counter()).update(_words(text.as_py()))
                if sum(map(len, counts.values())) > held:
                    yield from out()
        yield from out()

    return run


def word_counts(texts: DataFrame) -> tuple[DataFrame, int]:
    """``lang, word, _key, n`` of every word, and the seed of the keys: no two words share one."""
    for seed in range(100):
        words = texts.mapInArrow(_counted(HELD, seed), "lang string, word string, _key long, n long")
        words = saved(words.groupBy("lang", "word", "_key").agg(F.sum("n").cast("long").alias("n")), "colloc-words")
        if words.groupBy("_key").agg(F.count(F.lit(1)).alias("same")).filter("same > 1").isEmpty():
            return words, seed
    raise RuntimeError("words share keys under every seed")


class Numbers:
    """Numbers of words in texts, in the order of their keys.

    With a sorted list of frequent keys a number is the place in it and rare
    words are END; without one, the number is the key itself.
    """

    def __init__(self, frequent: np.ndarray | None, seed: int):
        self.frequent, self.seed, self.known, self.older, self.held = frequent, seed, {}, {}, 0
        self.dtype = np.dtype("<i8" if frequent is None else "<i4")

    def _number(self, lang: bytes, word: bytes) -> int:
        key = _key(lang, word, self.seed)
        if self.frequent is None:
            return key
        at = int(np.searchsorted(self.frequent, key))
        return at + 1 if at < len(self.frequent) and self.frequent[at] == key else END

    def of(self, lang: bytes, words: list[bytes]) -> np.ndarray:
        if self.held > REMEMBERED:
            self.known, self.older, self.held = {}, self.known, 0
        known, older = self.known.setdefault(lang, {b".": END}), self.older.get(lang, {})
        new = [w for w in set(words) if w not in known]
        for word in new:
            number = older.get(word)
            known[word] = self._number(lang, word) if number is None else number
        self.held += len(new)
        return np.fromiter(map(known.__getitem__, words), self.dtype, len(words))

    def keys(self, numbers: np.ndarray) -> np.ndarray:
        """Keys of numbers other than END."""
        return numbers.astype(np.int64) if self.frequent is None else self.frequent[numbers - 1]


def suffixes(numbers: np.ndarray, longest: int, upto: int | None = None) -> np.ndarray:
    """Rows of up to ``longest`` numbers from each place (before ``upto``) on, ended by END; those of one word are left out."""
    n = len(numbers) if upto is None else min(upto, len(numbers))
    padded = np.concatenate([numbers, np.full(longest, END, numbers.dtype)])
    start = np.flatnonzero((padded[:n] != END) & (padded[1: n + 1] != END))
    out = np.empty((len(start), longest), numbers.dtype)
    there = np.ones(len(start), bool)
    for d in range(longest):
        there &= padded[start + d] != END
        out[:, d] = np.where(there, padded[start + d], END)
    return out


def merged(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows in order, with the sums of their counts."""
    order = np.lexsort(rows.T[::-1])
    rows, counts = rows[order], counts[order]
    at = np.flatnonzero(np.concatenate([np.ones(min(1, len(rows)), bool), (rows[1:] != rows[:-1]).any(axis=1)]))
    return rows[at], np.add.reduceat(counts, at) if len(at) else counts


def _batches(texts, numbers: Numbers, longest: int, size: int):
    """Suffix rows of about ``size`` words of a task's texts at a time; a very long text is cut, with an overlap."""
    held, n = [], 0
    end = np.full(1, END, numbers.dtype)
    for batch in texts:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            got = numbers.of(lang.encode(), _words(text.as_py()))
            for at in range(0, len(got), size) if len(got) > size else ():
                yield suffixes(got[at: at + size + longest], longest, size)
            if len(got) <= size:
                held += [got, end]
                n += len(got)
            if n >= size:
                yield suffixes(np.concatenate(held), longest)
                held, n = [], 0
    if held:
        yield suffixes(np.concatenate(held), longest)


_CODEC = "zstd"


def _routed(frequent, seed: int, longest: int, splitters: np.ndarray, size: int):
    """(_range, _rows, _bytes): ordered suffixes and counts of a batch for each range, column after column."""

    def run(texts):
        numbers = Numbers(None if frequent is None else frequent.value, seed)
        for rows in _batches(texts, numbers, longest, size):
            rows, counts = merged(rows, np.ones(len(rows), np.int64))
            # Where each splitter falls among the ordered rows, word after word.
            cuts = [0]
            for s in splitters.astype(numbers.dtype):
                low, high = 0, len(rows)
                for d in range(longest):
                    column = rows[low:high, d]
                    low, high = low + int(np.searchsorted(column, s[d], "left")), low + int(np.searchsorted(column, s[d], "right"))
                cuts.append(low)
            cuts.append(len(rows))
            out = [(k, b - a, np.concatenate([np.ascontiguousarray(rows[a:b].T).view(np.uint8).ravel(), counts[a:b].astype("<i4").view(np.uint8)]))
                   for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _, _ in out], pa.int32()), pa.array([n for _, n, _ in out], pa.int64()),
                 pa.array([pa.compress(b.tobytes(), codec=_CODEC, asbytes=True) for _, _, b in out], pa.binary())], names=["_range", "_rows", "_bytes"])

    return run


def three_way(rows: np.ndarray, counts: np.ndarray, least: int) -> list[tuple[tuple[int, ...], int]]:
    """Phrases of two or more leading words whose counts sum up to ``least`` or more, with the sums.

    Multikey quicksort of row pointers: a partition by the word at a depth gives
    smaller, equal and greater rows; the equal ones go on with the next word.
    Partitions with a sum below ``least`` are abandoned.
    """
    out, longest = [], rows.shape[1] if rows.ndim == 2 else 0
    columns = [np.ascontiguousarray(rows[:, d]) for d in range(longest)]
    todo = [(np.arange(len(rows)), 0, ())] if longest else []
    while todo:
        pointers, depth, phrase = todo.pop()
        words = columns[depth][pointers]
        some = words[:: max(1, len(words) // 9)]
        pivot = int(np.sort(some)[len(some) // 2])
        less, equal = words < pivot, words == pivot
        for side in (pointers[less], pointers[~(less | equal)]):
            if len(side) and counts[side].sum() >= least:
                todo.append((side, depth, phrase))
        if pivot == END:
            continue
        same = pointers[equal]
        total = int(counts[same].sum())
        if total >= least:
            longer = (*phrase, pivot)
            if depth:
                out.append((longer, total))
            if depth + 1 < longest:
                todo.append((same, depth + 1, longer))
    return out


def ends(rows: np.ndarray, counts: np.ndarray, least: int) -> list[tuple[tuple[int, ...], int]]:
    """Phrases that the first or the last row begins with and that count less than ``least`` here."""
    out = {}
    if len(rows):
        order = np.lexsort(rows.T[::-1])
        for end in (rows[order[0]], rows[order[-1]]):
            same = np.ones(len(rows), bool)
            for d, word in enumerate(end.tolist()):
                if word == END:
                    break
                same &= rows[:, d] == word
                total = int(counts[same].sum())
                if d and total < least:
                    out[tuple(end[: d + 1].tolist())] = total
    return list(out.items())


def _sorted(frequent, longest: int, least: int):
    def run(table: pa.Table) -> pa.Table:
        numbers = Numbers(None if frequent is None else frequent.value, 0)
        rows, counts = [], []
        for n, packed in zip(table.column("_rows").to_pylist(), table.column("_bytes")):
            width = n * longest * numbers.dtype.itemsize
            raw = pa.decompress(packed.as_py(), width + 4 * n, codec=_CODEC, asbytes=True)
            rows.append(np.frombuffer(raw, numbers.dtype, n * longest).reshape(longest, n).T)
            counts.append(np.frombuffer(raw, "<i4", n, width))
        rows, counts = np.concatenate(rows), np.concatenate(counts).astype(np.int64)
        found = three_way(rows, counts, least) + ends(rows, counts, least)
        return pa.table({"phrase": pa.array([numbers.keys(np.array(p)).tolist() for p, _ in found], pa.list_(pa.int64())),
                         "f": pa.array([f for _, f in found], pa.int64())})

    return run


def _sample(frequent, seed: int, longest: int, share: float):
    def run(texts):
        numbers = Numbers(None if frequent is None else frequent.value, seed)
        for rows in _batches(texts, numbers, longest, BATCH):
            some = rows[np.random.default_rng(len(rows)).random(len(rows)) < share].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(some.tolist(), pa.list_(pa.int64()))], names=["row"])

    return run


def frequent_phrases(texts: DataFrame, words: DataFrame, seed: int, least: int, longest: int, size: int = RANGE,
                     sent: int = SENT) -> DataFrame:
    """``phrase, f``: key lists of 2 to ``longest`` words that occur ``least`` times or more inside pieces."""
    spark = texts.sparkSession
    often = words.filter(F.col("n") >= least)
    sizes = words.agg(F.sum("n").alias("all"), F.count(F.when(F.col("n") >= least, 1)).alias("often")).first()
    frequent = None
    if sizes["often"] <= sent:  # eight bytes each
        frequent = spark.sparkContext.broadcast(np.sort(often.select("_key").toArrow().column(0).to_numpy()))
    ranges = min(RANGES, -(-(sizes["all"] or 0) // size) or 1)
    splitters = np.zeros((0, longest), np.int64)
    if ranges > 1:
        rows = texts.count()
        some = texts if rows <= SAMPLED else texts.sample(SAMPLED / rows, seed=7)
        share = min(1.0, ranges * PER_RANGE / max(1.0, sizes["all"] * min(1.0, SAMPLED / rows)))
        got = some.mapInArrow(_sample(frequent, seed, longest, share), "row array<long>").toArrow().column(0).to_pylist()
        if got:
            got = sorted(map(tuple, got))
            splitters = np.array(sorted({got[len(got) * k // ranges] for k in range(1, ranges)}), np.int64)
    routed = texts.mapInArrow(_routed(frequent, seed, longest, splitters, BATCH), "_range int, _rows long, _bytes binary")
    # As many tasks as ranges: their number follows the words, and adaptive execution does not merge them.
    found = routed.repartition(ranges, "_range").groupBy("_range").applyInArrow(_sorted(frequent, longest, least), "phrase array<long>, f long")
    return found.groupBy("phrase").agg(F.sum("f").cast("long").alias("f")).filter(F.col("f") >= least)


def score(a: str, n: str, left: str, right: str) -> Column:
    """floor(1000 a n / (left right)) in exact decimals, for counts below 10^17."""
    return F.expr(f"(CAST(1000 AS DECIMAL(4,0)) * CAST({a} AS DECIMAL(17,0)) * CAST({n} AS DECIMAL(17,0)))"
                  f" div (CAST({left} AS DECIMAL(19,0)) * CAST({right} AS DECIMAL(19,0)))")


def mined(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5, top: int = 2000,
          size: int = RANGE, sent: int = SENT) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` collocations of each language.

    Pieces end at punctuation and line ends, A-Z is lower-cased, words are parted
    by spaces and tabs.  Null texts have no words, a null language is ``und``,
    repeated rows count each, an empty table gives no rows; extra columns are
    not read.  ``sent``: see SENT; both ways give the same rows.
    """
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("_text"))
    words, seed = word_counts(texts)
    found = saved(frequent_phrases(texts, words, seed, least, longest, size, sent), "colloc-phrases")
    # A phrase inside a longer one that is as frequent is inside one with a single word more that is.
    long = found.filter(F.size("phrase") > 2)
    inside = long.select(F.explode(F.array(F.slice("phrase", 1, F.size("phrase") - 1), F.slice("phrase", 2, F.size("phrase") - 1))).alias("phrase"), "f")
    inside = inside.groupBy("phrase").agg(F.max("f").alias("_f"))
    kept = found.join(inside, "phrase", "left").filter("_f IS NULL OR 100 * _f < 100 * f").select("phrase", F.col("f").alias("a"))
    # Counts of both parts of every cut.
    often = words.filter(F.col("n") >= least)
    parts = found.select("phrase", "f", F.lit(None).cast("string").alias("lang")).unionByName(
        often.select(F.array("_key").alias("phrase"), F.col("n").alias("f"), "lang"))
    cuts = kept.select("phrase", "a", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k"))
    cuts = cuts.withColumns({"_left": F.slice("phrase", F.lit(1), F.col("k")), "_right": F.slice("phrase", F.col("k") + 1, F.size("phrase") - F.col("k"))})
    cuts = cuts.join(parts.select(F.col("phrase").alias("_left"), F.col("f").alias("l"), "lang"), "_left")
    cuts = cuts.join(parts.select(F.col("phrase").alias("_right"), F.col("f").alias("r")), "_right")
    totals = words.groupBy("lang").agg(F.sum("n").cast("long").alias("n"))
    scored = cuts.groupBy("phrase").agg(F.first("a").alias("a"), F.max("lang").alias("lang"), F.collect_list(F.struct("k", "l", "r")).alias("_cuts"))
    scored = scored.join(totals, "lang").withColumn("_cut", F.explode("_cuts")).withColumn("score", score("a", "n", "_cut.l", "_cut.r"))
    scored = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "_cut")).alias("_low"))
    scored = scored.select("lang", "phrase", "a", "n", "_low.score", "_low._cut.l", "_low._cut.r")
    # Words are looked up for the best ones and those tied with the last of them only.
    best = scored.withColumn("_rank", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))).filter(F.col("_rank") <= top)
    spelt = best.select("lang", "phrase", "a", "l", "r", "n", "score", F.posexplode("phrase").alias("_at", "_key")).join(
        words.select("_key", "word"), "_key")
    spelt = spelt.groupBy("lang", "phrase", "a", "l", "r", "n", "score").agg(F.array_sort(F.collect_list(F.struct("_at", "word"))).alias("_w"))
    named = spelt.withColumn("phrase", F.array_join(F.col("_w.word"), " "))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return named.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
