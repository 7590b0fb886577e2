"""Spelling variants: words one edit apart, found with a bit-sliced position index.

Words that differ by one edit agree on two of three segments of the longer one
(the last segments counted from the end).  Every word is dealt to a group for
each of the three ways, once as the longer and once as the shorter word, so
only groups are compared and none needs the whole vocabulary.

Inside a group the index holds, for each position and letter, the set of words
with that letter there, as bits.  A query letter moves four sets of words at
once: no error yet, one letter replaced, one letter more in the word (positions
shifted by one) and one letter less (shifted back).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from terraloom.llm.common import A_TO_Z, saved

# Fixed values of the contract.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans(A_TO_Z, A_TO_Z.lower())
MODULUS = 97

#: Words that a counting task holds before it hands counts on.
HELD = 300_000
#: Words of a group from which it is cut into blocks, and of an index.
BLOCK = 2048
#: Rows of a shuffle group, and such groups at most.
DEALT, TASKS = 50_000, 20_000


def _counted(held: int):
    """(word, n) of a task's texts, after the deletions that the id decides."""

    def run(batches):
        counts: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                runs = RUN.findall((text.as_py() or "").translate(LOWER))
                if not runs:
                    continue
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for run, n in Counter(runs).items():
                    h = zlib.crc32(run.encode(), seed)
                    if h % MODULUS == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                    if run:
                        counts[run] += n
                if len(counts) > held:
                    yield out()
                    counts.clear()
        yield out()

    return run


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 5, least_count: int = 3) -> DataFrame:
    """``word, n``: words of at least ``least_length`` code points with their number of occurrences, if at least ``least_count``.

    Words are runs of western letters, A-Z lower-cased; where the checksum of id
    and run says so, a run loses one letter first.  Null texts have none, a null
    id counts as an empty one, repeated rows count each.
    """
    bare = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    counts = bare.mapInArrow(_counted(HELD), "word string, n long")
    return (counts.filter(F.length("word") >= least_length).groupBy("word").agg(F.sum("n").cast("long").alias("n"))
            .filter(F.col("n") >= least_count))


class Letters:
    """Code points of words, by word and position."""

    def __init__(self, words: pa.ChunkedArray):
        texts = words.to_pylist()
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum([0, *self.lengths])[:-1]
        self.points = np.frombuffer("".join(texts).encode("utf-32-le") + bytes(4), "<i4")

    def of(self, rows: np.ndarray, width: int) -> np.ndarray:
        """One row per word, 0 behind its end."""
        k = np.arange(width)
        inside = k < self.lengths[rows][:, None]
        return np.where(inside, self.points[np.where(inside, self.starts[rows][:, None] + k, -1)], 0)


class PositionIndex:
    """For each position and letter the words that have it there, as rows of bits."""

    def __init__(self, letters: np.ndarray, lengths: np.ndarray):
        self.words, self.width = letters.shape
        self.room = -(-self.words // 64) * 64
        self.alphabet = np.unique(letters[letters > 0])
        self.slices = np.zeros((self.width + 2, len(self.alphabet) + 1, self.room // 64), np.uint64)
        for p in range(self.width):  # slice p + 1, so that a shift by one needs no test; the last letter row stays empty
            for c in np.unique(letters[:, p]):
                if c:
                    self.slices[p + 1, np.searchsorted(self.alphabet, c)] = self._bits(letters[:, p] == c)
        self.of_length = {int(n): self._bits(lengths == n) for n in np.unique(lengths)}

    def _bits(self, rows: np.ndarray) -> np.ndarray:
        full = np.zeros((*rows.shape[:-1], self.room), bool)
        full[..., : self.words] = rows
        return np.packbits(full, axis=-1, bitorder="little").view(np.uint64)

    def near(self, queries: np.ndarray, length: int, group: np.ndarray, groups: np.ndarray, replaced: bool, longer: bool,
             shorter: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers of pairs exactly one edit apart; queries all have ``length``.

        ``group`` and ``groups``: only words of the query's own group; the flags say which edits are asked for.
        """
        at = np.searchsorted(self.alphabet, queries)
        at[at == len(self.alphabet)] = 0
        at = np.where(self.alphabet[at] == queries, at, len(self.alphabet)) if len(self.alphabet) else at
        none = self._bits(group[:, None] == groups[None, :])
        swap, more, less = np.zeros_like(none), np.zeros_like(none), np.zeros_like(none)
        empty = np.zeros_like(none)
        for i in range(length):
            here = self.slices[i + 1, at[:, i]] if i < self.width else empty
            if longer:
                after = self.slices[i + 2, at[:, i]] if i + 1 < self.width else empty
                more = (more | none) & after
            if shorter:
                less = (less & self.slices[i, at[:, i]]) | none if i <= self.width else none
            if replaced:
                swap = (swap & here) | (none & ~here)
            none = none & here
        nothing = np.zeros(self.room // 64, np.uint64)
        found = np.zeros_like(none)
        if replaced:
            found |= swap & self.of_length.get(length, nothing)
        if longer:
            found |= (more | none) & self.of_length.get(length + 1, nothing)
        if shorter:
            found |= less & self.of_length.get(length - 1, nothing)
        rows, cells = np.nonzero(found)
        bits = np.unpackbits(found[rows, cells].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
        pair, bit = np.nonzero(bits)
        return rows[pair], cells[pair] * 64 + bit


def segments(longer: int) -> tuple[int, int, int]:
    """Lengths of the three segments of a word of that length."""
    a = longer // 3
    b = (longer - a) // 2
    return a, b, longer - a - b


def _ways(word):
    """Group keys of a word: as the longer and as the shorter of a pair, one for each two segments that may agree."""
    length = F.length(word)
    out = []
    for more in (0, 1):
        whole = length + more
        a = F.floor(whole / 3).cast("int")
        b = F.floor((whole - a) / 2).cast("int")
        c = whole - a - b
        left = lambda k: F.substring(word, F.lit(1), k)
        right = lambda k: F.substring(word, length - k + 1, k)
        keys = (left(a + b), F.concat(left(a), F.lit("-"), right(c)), right(b + c))
        out += [F.struct(whole.alias("_longer"), F.lit(way).alias("_way"), key.alias("_key")) for way, key in enumerate(keys)]
    return F.explode(F.array(*out))


def _first_way(a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray, longer: int) -> np.ndarray:
    """The first of the three ways in which each pair of words meets."""
    first, middle, last = segments(longer)
    k = np.arange(a.shape[1])

    def run(same):
        return np.where(same.all(axis=1), same.shape[1], np.argmin(same, axis=1))

    head = run(a == b)
    back = lambda m, n: np.take_along_axis(m, np.maximum(n[:, None] - 1 - k, 0), axis=1)
    tail = run((back(a, la) == back(b, lb)) & (k < np.minimum(la, lb)[:, None]))
    return np.where(head >= first + middle, 0, np.where((head >= first) & (tail >= last), 1, 2))


def _runs(same: np.ndarray, start: int, end: int, block: int) -> list[np.ndarray]:
    """Rows from ``start`` to ``end`` in chunks of whole groups, up to ``block`` rows unless a group is larger."""
    first = np.append(np.flatnonzero(~same[start:end]), end - start) + start
    out, at = [], start
    while at < end:
        k = int(np.searchsorted(first, at + block, "right")) - 1
        upto = int(first[k]) if first[k] > at else int(first[k + 1])
        out.append(np.arange(at, upto))
        at = upto
    return out


def _compared(block: int):
    """Near words of the queries of one shuffle group: word, how many, and the best of them."""
    by = ("_longer", "_way", "_key", "_query", "_index")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in by])
        codes = [np.asarray(table.column(c).combine_chunks().dictionary_encode().indices) for c in by]
        longer, way = (table.column(c).to_numpy() for c in ("_longer", "_way"))
        asks, answers = (table.column(c).to_numpy() for c in ("_asks", "_answers"))
        # ``same``: the row is of the group of the row before it.
        same = np.concatenate([[False], np.logical_and.reduce([c[1:] == c[:-1] for c in codes])])
        group = np.cumsum(~same)
        letters, pairs = Letters(table.column("word")), [(np.zeros(0, np.int64),) * 2]
        changes = [0, *(np.flatnonzero(longer[1:] != longer[:-1]) + 1).tolist(), len(longer)]
        for start, end in zip(changes, changes[1:]):
            width = int(longer[start])
            # Long words have many positions: fewer of them in an index.
            most = max(64, (1 << 18) // width)
            for chunk in _runs(same, start, end, block):
                there = chunk[answers[chunk]]
                for some in np.array_split(there, -(-len(there) // most)) if len(there) else ():
                    held = letters.of(some, width)
                    index = PositionIndex(held, letters.lengths[some])
                    for length in (width, width - 1):
                        queries = chunk[asks[chunk] & (letters.lengths[chunk] == length)]
                        for part in np.array_split(queries, -(-len(queries) // min(512, most))) if len(queries) else ():
                            asked, full = letters.of(part, width), length == width
                            q, w = index.near(asked, length, group[part], group[some], full, not full, full)
                            first = _first_way(asked[q], held[w], letters.lengths[part[q]], letters.lengths[some[w]], width)
                            keep = first == way[part[q]]
                            pairs.append((part[q[keep]], some[w[keep]]))
        asked, found = (np.concatenate(x) for x in zip(*pairs))
        names = table.column("word").combine_chunks().dictionary_encode()
        word, rank = np.asarray(names.indices), np.empty(len(names.dictionary), np.int64)
        rank[np.asarray(pa.compute.sort_indices(names.dictionary))] = np.arange(len(rank))
        n = table.column("n").to_numpy()
        order = np.lexsort((rank[word[found]], -n[found], word[asked]))
        who, at, near = np.unique(word[asked][order], return_index=True, return_counts=True)
        best = found[order][at]
        return pa.table({"word": names.dictionary.take(pa.array(who)), "_near": pa.array(near, pa.int64()),
                         "_best_n": pa.array(n[best], pa.int64()), "_best": table.column("word").take(pa.array(best))})

    return run


def neighbours(words: DataFrame, block: int = BLOCK, dealt: int = DEALT) -> DataFrame:
    """``word, n_near, best, best_n``: how many of ``words`` (word, n) lie one edit away, and the most frequent of these.

    Words without a near one are left out.  Groups of more than ``block`` words
    are cut into blocks, each pair of which is compared in a group of its own.
    """
    rows = words.select("word", "n", _ways(F.col("word")).alias("_w")).select("word", "n", "_w.*")
    sizes = saved(rows.groupBy("_longer", "_way", "_key").agg(F.count(F.lit(1)).alias("_size")).filter("_size > 1"), "variant-groups")
    # Alone in its group, a word has nothing to meet there.
    rows = rows.join(sizes, ["_longer", "_way", "_key"])
    cut = F.ceil(F.col("_size") / block).cast("int")
    mine = F.pmod(F.xxhash64("word"), F.col("_cut")).cast("int")
    rows = rows.withColumn("_cut", cut).withColumn("_mine", F.when(F.col("_cut") > 1, mine).otherwise(0))
    # The block of a word asks all blocks, and answers all blocks.
    each = F.explode(F.sequence(F.lit(0), F.col("_cut") - 1))
    ask = rows.withColumn("_index", each).withColumn("_query", F.col("_mine"))
    answer = rows.filter("_cut > 1").withColumn("_query", each).withColumn("_index", F.col("_mine")).filter("_query <> _index")
    ask = ask.withColumns({"_asks": F.lit(True), "_answers": F.col("_index") == F.col("_query")})
    met = ask.unionByName(answer.withColumns({"_asks": F.lit(False), "_answers": F.lit(True)}))
    n_groups = sizes.agg(F.sum("_size").alias("n")).first()["n"] or 0
    groups = min(TASKS, -(-n_groups // dealt) or 1)
    met = met.withColumn("_group", F.pmod(F.xxhash64("_longer", "_way", "_key", "_query", "_index"), F.lit(groups)))
    met = met.select("_group", "word", "n", "_longer", "_way", "_key", "_query", "_index", "_asks", "_answers")
    # An explicit number of partitions: adaptive execution would merge these few bytes into one long task.
    found = met.repartition(groups, "_group").groupBy("_group").applyInArrow(_compared(block), "word string, _near long, _best_n long, _best string")
    best = F.min(F.struct((-F.col("_best_n")).alias("m"), F.col("_best").alias("w")))
    return found.groupBy("word").agg(F.sum("_near").alias("n_near"), best.alias("_b")).select(
        "word", "n_near", F.col("_b.w").alias("best"), (-F.col("_b.m")).alias("best_n"))


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 5, least_count: int = 3, ratio: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the vocabulary.

    ``form``: the most frequent near word (ties: the smallest), if it is at
    least ``ratio`` times as frequent; ``root``: where following forms ends.
    Counts at least double on the way, so a few rounds of doubling find every
    root.  See ``vocabulary`` for null and odd rows; an empty table gives none.
    """
    words = saved(vocabulary(docs, doc_id, text, least_length, least_count), "variant-words")
    all_words = saved(words.join(neighbours(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best")).alias("form"),
        F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_n")).alias("form_n")), "variant-forms")
    # Pointer doubling: after each round ``to`` is twice as far along.
    links = all_words.filter("form IS NOT NULL").select("word", F.col("form").alias("to"))
    while True:
        ahead = links.select(F.col("word").alias("to"), F.col("to").alias("_next"))
        links = saved(links.join(ahead, "to", "left").select(
            "word", F.coalesce("_next", "to").alias("to"), F.col("_next").isNotNull().alias("_moved")), "variant-roots")
        if links.filter("_moved").isEmpty():
            break
        links = links.drop("_moved")
    return all_words.join(links.select("word", F.col("to").alias("_root")), "word", "left").select(
        "word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")
