"""Ranked lexical search by pipelined term partitioning.

The inverted index is a table of chunks: the documents and frequencies of one term in
one slice of documents. Terms belong to owners, the rarest to the first owner, so that
each owner has about as many postings. Items travel in bundles of at most
``BUNDLE_ITEMS`` items: a bundle visits the owners one after the other, meets the
owner's chunks by cogroup, adds their integer contributions to its sparse accumulators
(item, document, score) and goes on to the next owner. Bundles and chunks meet slice by
slice, so that no task holds the postings of a common term or the accumulators of a
common item, only those of ``SLICE_DOCS`` documents and one bundle.

After each owner a bundle drops the documents that cannot be among the best any more:
those whose score, with all that the later owners could add, stays below the score that
enough documents of the slice have by now. No result depends on it. The last owner's
visit selects the best of each slice, and a window the best of all slices.

Documents are read once. The index holds only terms that some item may have: tasks ask
a bit table of fixed size (``TABLE_BITS``), which passes some other terms too; the join
with the items' terms drops these.

Defined cases: null and empty texts have no terms; such documents count nowhere and such
items have no result; rows that repeat a doc_id are documents of their own; rows that
repeat an item are ranked each; documents without doc_id come last among equal scores;
other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.llm.common import BROADCAST_ROWS, apart, attach, in_small_batches
from orderflow.session import stage

BEST = 20
OWNERS = 4
BUNDLE_ITEMS, BUNDLE_TERMS = 256, 65_536
#: A slice ends at so many documents or bytes of text.
SLICE_DOCS, SLICE_BYTES = 4_096, 32_000_000
TABLE_BITS = 20
#: Bundles up to this number are broadcast to the slices.
BROADCAST_BUNDLES = 8
#: Words of which a worker remembers whether an item may have them.
KNOWN_WORDS = 200_000
#: More than one occurrence of a term can add, whatever its frequency: 10**9 / 1000.
MOST = 1_000_000

ITEM_TERMS = "bundle long, item int, item_id long, term string, times long"
INDEX = ("slice long, term string, docs array<int>, tfs array<int>, ids array<long>, "
         "sizes array<long>, filled long, words long")
BUNDLES = ("slice long, bundle long, ids array<long>, sizes array<long>, q_owner array<int>, "
           "q_number array<int>, q_item array<int>, q_value array<long>, "
           "items array<int>, docs array<int>, scores array<long>")
RANKED = "bundle long, item int, doc_id long, score long"
KEY = ["slice", "bundle"]


def _letters() -> bytes:
    """A-Z in lower case; a blank for every ASCII character but letters and digits."""
    return bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32
                 for b in range(256))


LETTERS = _letters()


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]


def _number(part: int, k: int) -> int:
    return part << 32 | k


def item_terms(items: DataFrame) -> DataFrame:
    """The terms of each item with the number of times, in numbered bundles; staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, bundle, item, held = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            for item_id, text in zip(batch.column("item_id").to_pylist(), _texts(batch)):
                times = Counter(terms_of(text))
                if not times:
                    continue
                if item == BUNDLE_ITEMS or held and held + len(times) > BUNDLE_TERMS:
                    bundle, item, held = bundle + 1, 0, 0
                n = len(times)
                yield pa.RecordBatch.from_arrays([
                    pa.array([_number(part, bundle)] * n, pa.int64()), pa.array([item] * n, pa.int32()),
                    pa.array([item_id] * n, pa.int64()),
                    pa.array(list(times), pa.binary()).cast(pa.string()),
                    pa.array(list(times.values()), pa.int64()),
                ], ["bundle", "item", "item_id", "term", "times"])
                item, held = item + 1, held + n

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return stage(in_small_batches(rows).mapInArrow(run, ITEM_TERMS), "item-terms")


def term_table(terms: DataFrame) -> bytes:
    """Bits of the hashes of all ``term``; at most 2**TABLE_BITS numbers reach the driver."""
    place = F.pmod(F.xxhash64("term"), F.lit(1 << TABLE_BITS))
    places = terms.select(place.alias("place")).distinct().toArrow().column(0).to_numpy()
    bits = np.zeros(1 << TABLE_BITS, np.uint8)
    bits[places] = 1
    return np.packbits(bits, bitorder="little").tobytes()


class _Slice:
    """The postings of the documents of one slice."""

    def __init__(self, table: bytes):
        self.table = table
        self.lists: dict[bytes, tuple[list[int], list[int]] | None] = {}
        self.clear()

    def clear(self) -> None:
        kept = {w: None for w, p in self.lists.items() if p is None}
        self.lists = kept if len(kept) <= KNOWN_WORDS else {}
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.bytes = 0

    def _wanted(self, word: bytes) -> bool:
        place = xxhash.xxh64_intdigest(word, 42) & (1 << TABLE_BITS) - 1
        return bool(self.table[place >> 3] >> (place & 7) & 1)

    def add(self, doc_id: int | None, text: bytes) -> None:
        words = terms_of(text)
        at, lists = len(self.ids), self.lists
        self.ids.append(doc_id)
        self.sizes.append(len(words))
        self.bytes += len(text)
        for word, n in Counter(words).items():
            found = lists.get(word, 0)
            if found == 0:
                found = lists[word] = ([], []) if self._wanted(word) else None
            if found is not None:
                found[0].append(at)
                found[1].append(n)

    def rows(self, number: int) -> pa.RecordBatch:
        """The slice's own row, then its chunks; documents are numbered by ascending doc_id."""
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        chunks = [(w, p) for w, p in self.lists.items() if p]
        none = [None] * len(chunks)
        return pa.RecordBatch.from_arrays([
            pa.array([number] * (len(chunks) + 1), pa.int64()),
            pa.array([None, *(w for w, _ in chunks)], pa.binary()).cast(pa.string()),
            pa.array([None, *(place[p[0]] for _, p in chunks)], pa.list_(pa.int32())),
            pa.array([None, *(p[1] for _, p in chunks)], pa.list_(pa.int32())),
            pa.array([[self.ids[i] for i in order], *none], pa.list_(pa.int64())),
            pa.array([[self.sizes[i] for i in order], *none], pa.list_(pa.int64())),
            pa.array([sum(n > 0 for n in self.sizes), *none], pa.int64()),
            pa.array([sum(self.sizes), *none], pa.int64()),
        ], ["slice", "term", "docs", "tfs", "ids", "sizes", "filled", "words"])


def index(docs: DataFrame, table: bytes) -> DataFrame:
    """Chunks of the terms that ``table`` passes, and a row without term for each slice; staged."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, held = TaskContext.get().partitionId(), 0, _Slice(shared.value)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), _texts(batch)):
                held.add(doc_id, text)
                if len(held.ids) >= SLICE_DOCS or held.bytes >= SLICE_BYTES:
                    yield held.rows(_number(part, k))
                    held.clear()
                    k += 1
        if held.ids:
            yield held.rows(_number(part, k))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stage(in_small_batches(rows).mapInArrow(run, INDEX), "term-index")


def owned_terms(wanted: DataFrame, chunks: DataFrame, filled: int, owners: int) -> DataFrame:
    """bundle, term, its number in the bundle, weight and owner; staged.

    Rare terms come first, and each owner has about as many postings of the bundle.
    """
    held = chunks.groupBy("term").agg(F.sum(F.size("docs")).cast("long").alias("df"))
    rate = F.lit(2.0 * filled + 2.0) / (2.0 * F.col("df") + 1.0)
    in_order = Window.partitionBy("bundle").orderBy("df", "term")
    before = F.sum("df").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("df")
    share = before / F.sum("df").over(Window.partitionBy("bundle"))
    return stage(
        wanted.select("bundle", "term").distinct().join(held, "term").select(
            "bundle", "term", (F.row_number().over(in_order) - 1).cast("int").alias("number"),
            F.floor(1000 * F.log(rate)).cast("long").alias("weight"),
            F.floor(share * owners).cast("int").alias("owner")),
        "owned-terms")


def _column(table: pa.Table, name: str) -> np.ndarray:
    """The list in the only row of ``table``."""
    return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    return pa.array(values, pa.list_(kind))


def _visit(owner: int, last: bool, filled: int, words: int, best: int):
    """One owner's visit: a bundle and the owner's chunks of one slice."""

    def visit(left: pa.Table, right: pa.Table) -> pa.Table:
        own, number, item, value = (
            _column(left, f"q_{c}") for c in ("owner", "number", "item", "value"))
        sizes = _column(left, "sizes").astype(np.int64)
        score = np.zeros((int(item.max()) + 1, len(sizes)), np.int64)
        score[_column(left, "items"), _column(left, "docs")] = _column(left, "scores")
        length = 75 + 25 * sizes * filled // words
        starts = right.column("docs").combine_chunks()
        docs, tfs = (right.column(c).combine_chunks().flatten().to_numpy() for c in ("docs", "tfs"))
        ends = np.cumsum(starts.value_lengths().to_numpy(zero_copy_only=False)).astype(int)
        begin = 0
        for term, end in zip(right.column("number").to_pylist(), ends.tolist()):
            a, b = np.searchsorted(number, (term, term + 1))
            at, tf = docs[begin:end], tfs[begin:end].astype(np.int64)
            part = 1_000_000_000 * tf // (1000 * tf + 12 * length[at])
            score[item[a:b, None], at[None, :]] += value[a:b, None] * part[None, :]
            begin = end
        later = np.bincount(item[own > owner], value[own > owner], len(score)).astype(np.int64)
        for i, row in enumerate(score):
            if np.count_nonzero(row) > best:
                row[row + later[i] * MOST < np.partition(row, -best)[-best]] = 0
        if last:
            return _best(score, _column(left, "ids"), left, best)
        items, at = np.nonzero(score)
        return pa.table({
            **{c: left.column(c) for c in left.column_names if c not in ("items", "docs", "scores")},
            "items": _lists([items.astype(np.int32)], pa.int32()),
            "docs": _lists([at.astype(np.int32)], pa.int32()),
            "scores": _lists([score[items, at]], pa.int64()),
        })

    return visit


def _best(score: np.ndarray, ids: np.ndarray, left: pa.Table, best: int) -> pa.Table:
    items, docs = np.nonzero(score)
    order = np.lexsort((docs, -score[items, docs], items))
    items, docs = items[order], docs[order]
    first = np.searchsorted(items, items)
    keep = np.arange(len(items)) - first < best
    items, docs = items[keep], docs[keep]
    doc_ids = left.column("ids").combine_chunks().flatten().take(pa.array(docs, pa.int64()))
    bundle = left.column("bundle")[0].as_py()
    return pa.table({
        "bundle": pa.array([bundle] * len(items), pa.int64()),
        "item": pa.array(items, pa.int32()),
        "doc_id": doc_ids,
        "score": pa.array(score[items, docs], pa.int64()),
    })


def search(docs: DataFrame, items: DataFrame, best: int = BEST, owners: int = OWNERS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``best`` documents of each item by score, then doc_id."""
    spark = docs.sparkSession
    wanted = item_terms(items)
    whole = index(docs, term_table(wanted))
    slices, chunks = whole.where("term IS NULL"), whole.where("term IS NOT NULL")
    filled, words = slices.agg(F.sum("filled"), F.sum("words")).first()
    if not filled:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    owned = owned_terms(wanted, chunks, filled, owners)
    side = F.broadcast(owned) if owned.count() <= BROADCAST_ROWS else owned
    met = chunks.join(side, "term").select(*KEY, "owner", "number", "docs", "tfs")

    entry = F.struct("number", "owner", "item", (F.col("weight") * F.col("times")).alias("value"))
    queries = stage(
        wanted.join(owned, ["bundle", "term"]).groupBy("bundle")
        .agg(F.sort_array(F.collect_list(entry)).alias("q"))
        .select("bundle", *[F.col(f"q.{c}").alias(f"q_{c}") for c in ("owner", "number", "item", "value")]),
        "bundles")
    none = [F.array().cast(f"array<{t}>").alias(c)
            for c, t in (("items", "int"), ("docs", "int"), ("scores", "long"))]
    pairs = met.select(*KEY).distinct().join(slices.select("slice", "ids", "sizes"), "slice")
    columns = [c.split()[0] for c in BUNDLES.split(", ")]
    bundles = attach(pairs, queries, ["bundle"], "inner", BROADCAST_BUNDLES).select(
        "*", *none).select(*columns)

    for owner in range(owners):
        last = owner == owners - 1
        own = apart(met.where(F.col("owner") == owner).drop("owner"))
        bundles = bundles.groupBy(*KEY).cogroup(own.groupBy(*KEY)).applyInArrow(
            _visit(owner, last, filled, words, best), RANKED if last else BUNDLES)

    order = Window.partitionBy("bundle", "item").orderBy(
        F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = bundles.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    names = wanted.select("bundle", "item", "item_id").distinct()
    return attach(ranked, names, ["bundle", "item"], "inner").select(
        "item_id", "rank", "doc_id", "score")
