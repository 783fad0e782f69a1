"""Phrase collocation mining with HAT-trie counting.

Texts become pieces at sentence marks and pieces words. Each task numbers the words it
meets and counts phrases in a HAT-trie for each language: a shallow trie over word
numbers whose leaves are hash containers of the rest of the phrase. A container that
outgrows ``BURST`` entries bursts into a trie node with a container for each next word.
A trie of more than ``ENTRIES`` entries spills its largest subtrees (all phrases with one
first word) as runs sorted by word numbers, until half of it is left. Runs are dealt by prefix
partition, language and first word, and those of a partition are merged by adding equal
phrases. The phrases of a very frequent first word are dealt to ``PARTS`` partitions.

A phrase is counted only if it can have ``LEAST`` occurrences: one word first, then
pairs of words that have as many themselves, then triples whose two pairs have. Words and
pairs are told by a bit table of fixed size (``TABLE_BITS``), which passes some more; the
counts of the passed ones are exact, and the rest cannot be a candidate or part of one.

Defined cases: null and empty texts have no words; null lang is ``und``; repeated rows
count again; ties in rank are ended by phrase; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.llm.common import attach, in_small_batches
from orderflow.session import stage

LEAST, LONGEST, BEST = 10, 3, 2_000
#: Percent of a phrase's occurrences inside one longer candidate that drop it.
COVERED = 50
#: Entries of a container before it bursts, and of a task's trie before it spills.
BURST, ENTRIES = 4_096, 700_000
#: First words with so many occurrences, and that share of a language's words, are split.
HOT, HOT_SHARE, PARTS = 1_000, 0.01, 64
#: Bits of a word's number: three fit in 63. A task with more words spills all and starts anew.
WORD_BITS = 21
TABLE_BITS = 25
#: Bytes of text, and words, that are counted at once.
PART, WINDOW = 1_000_000, 400_000
RUNS = "lang string, first string, part int, rests array<string>, counts array<long>"
MARK = b"\xff"


def _letters() -> bytes:
    """A-Z in lower case, marks that end a piece as one byte that no UTF-8 text has, tab as blank."""
    table = bytearray(range(256)).lower()
    for b in b".,;:!?\n\x0b\x0c\r":
        table[b] = 255
    table[9] = 32
    return bytes(table)


LETTERS = _letters()


def parts_of(text: bytes, most: int = PART) -> Iterator[bytes]:
    """``text`` with ``LETTERS`` in parts of about ``most`` bytes, cut at marks, which no phrase crosses."""
    text, at = text.translate(LETTERS), 0
    while len(text) - at > most and (cut := text.find(MARK, at + most)) >= 0:
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


# --- the trie -------------------------------------------------------------------------------


class Node(dict):
    """Children by word number; a plain dict is a container of packed rests."""


class HatTrie:
    """Counts of phrases of ``words`` word numbers, packed into one integer each."""

    def __init__(self, words: int, burst: int = BURST):
        self.words, self.burst, self.size = words, burst, 0
        self.root: dict = {}

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds to counts; ``keys`` are in order, so phrases with one first word come together."""
        if type(self.root) is not Node:
            self._into(None, 0, self.root, self.words, keys.tolist(), counts.tolist())
            return
        below = self.words - 1
        firsts, rests = keys >> WORD_BITS * below, keys & (1 << WORD_BITS * below) - 1
        ends = [*(np.flatnonzero(np.diff(firsts)) + 1).tolist(), len(keys)] if len(keys) else []
        firsts, rests, numbers = firsts.tolist(), rests.tolist(), counts.tolist()
        begin = 0
        for end in ends:
            first = firsts[begin]
            child = self.root.get(first)
            if child is None:
                self.root[first] = dict(zip(rests[begin:end], numbers[begin:end]))
                self.size += end - begin
            else:
                self._into(self.root, first, child, below, rests[begin:end], numbers[begin:end])
            begin = end

    def _into(self, above: Node | None, edge: int, node: dict, below: int, keys: list[int],
              counts: list[int]) -> None:
        """Adds rests of phrases below ``node``, the child of ``above`` at ``edge``."""
        if type(node) is Node:
            below -= 1
            mask = (1 << WORD_BITS * below) - 1
            for key, n in zip(keys, counts):
                at = key >> WORD_BITS * below
                self._into(node, at, node.setdefault(at, {}), below, [key & mask], [n])
            return
        before, get = len(node), node.get
        for key, n in zip(keys, counts):
            node[key] = get(key, 0) + n
        self.size += len(node) - before
        if below > 1 and len(node) > self.burst:
            self._burst(above, edge, node, below - 1)

    def _burst(self, above: Node | None, edge: int, full: dict, below: int) -> None:
        node, mask = Node(), (1 << WORD_BITS * below) - 1
        for key, n in full.items():
            node.setdefault(key >> WORD_BITS * below, {})[key & mask] = n
        if above is None:
            self.root = node
        else:
            above[edge] = node

    def spill(self, left: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Packed phrases in order, with counts, of the largest subtrees, until ``left`` remain."""
        if type(self.root) is not Node:
            self._burst(None, 0, self.root, self.words - 1)
        below = self.words - 1
        sizes = {first: _entries(child) for first, child in self.root.items()}
        firsts: list[int] = []
        rests: list[int] = []
        counts: list[int] = []
        for first in sorted(sizes, key=sizes.get, reverse=True):
            if self.size <= left:
                break
            firsts += [first] * sizes[first]
            _take(self.root.pop(first), below, 0, rests, counts)
            self.size -= sizes[first]
        keys = np.array(firsts, np.int64) << WORD_BITS * below | np.array(rests, np.int64)
        order = np.argsort(keys)
        return keys[order], np.array(counts, np.int64)[order]


def _entries(node: dict) -> int:
    return sum(map(_entries, node.values())) if type(node) is Node else len(node)


def _take(node: dict, below: int, base: int, rests: list[int], counts: list[int]) -> None:
    """Adds the packed rests and counts below ``node``, which stands after the words of ``base``."""
    if type(node) is Node:
        for edge, child in node.items():
            _take(child, below - 1, base | edge << WORD_BITS * (below - 1), rests, counts)
        return
    rests += [base | key for key in node] if base else node
    counts += node.values()


# --- which phrases to count -----------------------------------------------------------------


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word, _seed(lang))


@lru_cache
def _seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ b >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ x >> np.uint64(32)) * np.uint64(0x94D049BB133111EB)


def _places(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _has(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _places(hashes)
    return (table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def bit_table(frequent: DataFrame) -> np.ndarray:
    """A bit for the hash of each phrase (lang, first, rest); 2**TABLE_BITS bits reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            first, rest = (
                np.fromiter((word_hash(x, w) for x, w in zip(langs, batch.column(c).cast(pa.binary()).to_pylist())),
                            np.uint64, batch.num_rows) for c in ("first", "rest"))
            alone = np.array([not r for r in batch.column("rest").to_pylist()], bool)
            at = _places(np.where(alone, first, _mixed(first, rest)))
            bits = np.left_shift(np.uint64(1), (at & 63).astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(bits)], ["cell", "bits"])

    cells = frequent.select("lang", "first", "rest").mapInArrow(run, "cell long, bits long")
    got = cells.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << TABLE_BITS - 6, np.int64)
    table[got.column("cell").to_numpy()] = got.column("bits").to_numpy()
    return table.view(np.uint8)


# --- counting -------------------------------------------------------------------------------


class _Words(dict):
    """Numbers of words from 1 on; the mark has 0."""

    def __init__(self):
        super().__init__({MARK: 0})
        self.list = [MARK]

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self.list)
        self.list.append(word)
        return at


class WordCounter:
    """The counts of one language's words in a task: the trie's first level, one container."""

    def __init__(self, lang: str):
        self.lang = lang
        self.words: Counter = Counter()

    @property
    def size(self) -> int:
        return len(self.words)

    def add(self, text: bytes) -> None:
        self.words.update(text.replace(MARK, b" ").split())

    def runs(self, left: int = 0) -> Iterator[pa.RecordBatch]:
        if not self.words:
            return
        words = sorted(self.words)
        counts = list(map(self.words.__getitem__, words))
        yield pa.RecordBatch.from_arrays([
            pa.array([self.lang] * len(words), pa.string()),
            pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()),
        ], ["lang", "first", "f"])
        self.words.clear()


class PhraseCounter:
    """The words and the trie of one language in a task."""

    def __init__(self, lang: str, length: int, tables: list[np.ndarray], hot: set[bytes]):
        self.lang, self.length, self.tables, self.hot = lang, length, tables, hot
        self._anew()

    def _anew(self) -> None:
        self.words, self.trie = _Words(), HatTrie(self.length)
        self.hashes = np.zeros(1, np.uint64)
        self.frequent = np.zeros(1, bool)

    @property
    def size(self) -> int:
        """Above all bounds if word numbers are about to outgrow their bits."""
        return self.trie.size if len(self.words.list) >> WORD_BITS - 1 == 0 else 1 << 62

    def _learn(self) -> None:
        """Hashes of new words, and whether they are frequent."""
        new = self.words.list[len(self.hashes):]
        got = np.fromiter((word_hash(self.lang, w) for w in new), np.uint64, len(new))
        self.hashes = np.concatenate([self.hashes, got])
        self.frequent = np.concatenate([self.frequent, _has(self.tables[0], got)])

    def add(self, text: bytes) -> None:
        """Counts in windows; each phrase begins in one. A word has any byte but blanks and marks."""
        tokens = text.replace(MARK, b" \xff ").split()
        at = np.array(list(map(self.words.__getitem__, tokens)), np.int64)
        if len(self.words.list) > len(self.hashes):
            self._learn()
        for begin in range(0, len(at), WINDOW):
            self._window(at[begin:begin + WINDOW + self.length - 1])

    def _window(self, at: np.ndarray) -> None:
        good = self.frequent[at]
        whole, keys = good, at
        for k in range(1, self.length):
            whole = whole[:-1] & good[k:]
            keys = keys[:-1] << WORD_BITS | at[k:]
        if self.length == 3:  # both pairs are frequent
            spots = np.flatnonzero(good[:-1] & good[1:])
            pair = np.zeros(max(len(at) - 1, 0), bool)
            pair[spots] = _has(self.tables[1], _mixed(self.hashes[at[spots]], self.hashes[at[spots + 1]]))
            whole = whole & pair[:-1] & pair[1:]
        self.trie.add(*np.unique(keys[whole], return_counts=True))

    def runs(self, left: int = 0) -> Iterator[pa.RecordBatch]:
        """Spilled subtrees, a row for each prefix partition of one, in the order of word numbers."""
        left = 0 if self.size > self.trie.size else left
        keys, counts = self.trie.spill(left)
        if len(keys):
            yield self._batch(keys, counts)
        if not left:
            self._anew()

    def _batch(self, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        names, mask = self.words.list, (1 << WORD_BITS) - 1
        firsts = keys >> WORD_BITS * (self.length - 1)
        rests = list(map(names.__getitem__, (keys >> WORD_BITS * (self.length - 2) & mask).tolist()))
        if self.length == 3:
            rests = list(map(b" ".join, zip(rests, map(names.__getitem__, (keys & mask).tolist()))))
        part = np.zeros(len(keys), np.int32)
        split = [self.words[w] for w in self.hot if w in self.words]
        for at in np.flatnonzero(np.isin(firsts, split)).tolist():
            part[at] = xxhash.xxh3_64_intdigest(rests[at]) % PARTS
        if part.any():
            order = np.lexsort((keys, part, firsts))
            firsts, part, counts = firsts[order], part[order], counts[order]
            rests = [rests[i] for i in order.tolist()]
        begins = np.flatnonzero(np.diff(firsts, prepend=-1) | np.diff(part, prepend=-1))
        offsets = pa.array(np.append(begins, len(keys)), pa.int32())
        first = pa.array(map(names.__getitem__, firsts[begins].tolist()), pa.binary())
        return pa.RecordBatch.from_arrays([
            pa.array([self.lang] * len(begins), pa.string()), first.cast(pa.string()),
            pa.array(part[begins], pa.int32()),
            pa.ListArray.from_arrays(offsets, pa.array(rests, pa.binary()).cast(pa.string())),
            pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
        ], ["lang", "first", "part", "rests", "counts"])


def _runs(docs: DataFrame, counter: Callable[[str], WordCounter | PhraseCounter], schema: str) -> DataFrame:
    """The runs of all tasks; ``counter`` makes the counter of a language in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, WordCounter | PhraseCounter] = {}

        def grown(lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
            if lang not in counters:
                counters[lang] = counter(lang)
            counters[lang].add(text)
            while sum(c.size for c in counters.values()) > ENTRIES:
                largest = max(counters.values(), key=lambda c: c.size)
                yield from largest.runs(largest.size // 2)

        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            held: dict[str, list[bytes]] = {}
            sizes: dict[str, int] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts):
                for part in parts_of(text or b""):
                    held.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part)
                    if sizes[lang] > PART:
                        yield from grown(lang, MARK.join(held.pop(lang)))
                        sizes[lang] = 0
            for lang, parts in held.items():
                yield from grown(lang, MARK.join(parts))
        for own in counters.values():
            yield from own.runs()

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return in_small_batches(rows).mapInArrow(run, schema)


def count_words(docs: DataFrame) -> DataFrame:
    """lang, first, rest (empty), f: occurrences of every word; staged."""
    runs = _runs(docs, WordCounter, "lang string, first string, f long")
    merged = runs.groupBy("lang", "first").agg(F.sum("f").alias("f"))
    return stage(merged.select("lang", "first", F.lit("").alias("rest"), "f"), "words")


def count_phrases(docs: DataFrame, length: int, tables: list[np.ndarray], hot: list[tuple[str, str]],
                  name: str) -> DataFrame:
    """lang, first, rest, f: occurrences of the phrases of ``length`` words that ``tables`` pass; staged.

    ``hot`` are first words (lang, word) whose phrases are dealt to several partitions.
    """
    shared = docs.sparkSession.sparkContext.broadcast([t.tobytes() for t in tables])

    def counter(lang: str) -> PhraseCounter:
        own = [np.frombuffer(t, np.uint8) for t in shared.value]
        return PhraseCounter(lang, length, own, {w.encode() for x, w in hot if x == lang})

    runs = _runs(docs, counter, RUNS).repartition("lang", "first", "part")
    one = F.explode(F.arrays_zip("rests", "counts")).alias("one")
    merged = (
        runs.select("lang", "first", "part", one)
        .groupBy("lang", "first", "part", F.col("one.rests").alias("rest"))
        .agg(F.sum("one.counts").alias("f"))
    )
    return stage(merged.select("lang", "first", "rest", "f"), name)


# --- scores ---------------------------------------------------------------------------------


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST, covered: int = COVERED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``best`` phrases of each language."""
    every = count_words(docs)
    total = stage(every.groupBy("lang").agg(F.sum("f").alias("n")), "word-totals")
    words = every.where(F.col("f") >= least)
    # at most 1 / HOT_SHARE words of a language
    hot = attach(words.where(F.col("f") >= HOT), total, ["lang"], "inner").where(
        F.col("f") >= F.col("n") * HOT_SHARE)
    hot = [tuple(r) for r in hot.select("lang", "first").collect()]
    tables = [bit_table(words)]
    pairs = count_phrases(docs, 2, tables, hot, "pairs").where(F.col("f") >= least)
    tables.append(bit_table(pairs))
    triples = count_phrases(docs, 3, tables, hot, "triples").where(F.col("f") >= least)
    return ranked(words, pairs, triples, total, best, covered)


def ranked(words: DataFrame, pairs: DataFrame, triples: DataFrame, total: DataFrame, best: int,
           covered: int) -> DataFrame:
    """Scores, the drop of covered phrases and ranks, from the frequent phrases of each length."""
    phrase = F.concat_ws(" ", "first", "rest").alias("phrase")
    f = F.col("f")
    second, third = (F.substring_index("rest", " ", i) for i in (1, -1))
    head, tail = F.concat_ws(" ", "first", second), F.col("rest")

    def cut(k: int, left: Column, right: Column) -> Column:
        return F.struct(F.lit(k).alias("k"), left.alias("left"), right.alias("right"))

    known = words.select("lang", F.col("first").alias("phrase"), f).unionByName(
        pairs.select("lang", phrase, f))
    cuts = pairs.select(
        "lang", phrase, f.alias("a"), cut(1, F.col("first"), F.col("rest")).alias("cut")
    ).unionByName(triples.select(
        "lang", phrase, f.alias("a"),
        F.explode(F.array(cut(1, F.col("first"), tail), cut(2, head, third))).alias("cut"),
    )).select("lang", "phrase", "a", "cut.*")
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(
            known.select("lang", F.col("phrase").alias(side), f.alias(name)), ["lang", side])
    scored = cuts.withColumns({"_a": _exact("a"), "_l": _exact("l"), "_r": _exact("r")}).withColumn(
        "score", F.expr("(CAST(1000000 AS DECIMAL(7,0)) * (_a * _a)) DIV (_l * _r)"))
    lowest = (
        scored.groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
        .select("lang", "phrase", "a", "low.l", "low.r", "low.score")
    )
    around = (
        triples.select("lang", F.explode(F.array(head, tail)).alias("phrase"), f)
        .groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    )
    left = lowest.join(around, ["lang", "phrase"], "left").where(
        "around IS NULL OR 100 * around < %d * a" % covered)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return attach(top, total, ["lang"], "inner").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
