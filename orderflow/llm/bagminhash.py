"""Near-duplicates by BagMinHash.

A text is the bag of its shingles of five words. Each shingle has a random process
of points (time, weight, component) of rate 1 for each unit of weight and time; the
signature holds, for each of ``SIZE`` components, the time of the first point below
the shingles' weights. Two bags share a component with a probability that equals
their weighted Jaccard similarity, and the estimate is unbiased.

The process is hierarchical: weights are split at 1, 2, 4, 8 ..., and each interval
between has a Poisson process of its own, whose rate is the interval's length; so a
weight w takes log w processes, not w. In the interval that contains w, a point's
place in the interval decides whether it lies below w. Points come in order of time
and stop once all components are filled.

Components are banded; texts that share a band are candidates, and are verified by
the overlap of their bags. Equal bags are one node from the start. In a bucket of n
nodes not all pairs are made: the first node is compared with all others. A bucket
whose nodes are then in different components is finished in blocks: its nodes outside
its largest component, the strays, are compared with all its nodes, inside tasks that
hold a bounded block of either, and only one link to each other component leaves a
task. So the classes are those of all candidate pairs, without a row for each.

Words are runs of letters and digits; in scripts that set no blanks between words
(``UNSPACED``) each character is a word.

Defined cases: texts of fewer than five words are one shingle; a text without any word is
near to equal texts only, and null to empty ones; rows without doc_id take the class of
their equals, or none; rows that repeat a doc_id have the class of their own text; extra
columns change nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import BROADCAST_ROWS, attach, in_small_batches, kept, number_within
from orderflow.llm.components import components
from orderflow.session import stage

SHINGLE = 5
SIMILARITY = 0.8
#: 20 bands of 5: a pair at 0.8 is missed with a probability of 0.0004.
BANDS, ROWS = 20, 5
SIZE = BANDS * ROWS
#: Strays and nodes of a bucket that one task compares, about.
STRAY_BLOCK, NODE_BLOCK = 256, 1024
#: Shingles whose points are drawn at once.
BATCH = 100_000
KNOWN_WORDS = 100_000
#: Thai, Lao, Myanmar, Khmer, kana, and Han characters.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(r"\w+")
WORD_OR_CHARACTER = re.compile(rf"[^\W{UNSPACED}]+|[{UNSPACED}]")
HAS_UNSPACED = re.compile(f"[{UNSPACED}]")
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    unspaced = not text.isascii() and HAS_UNSPACED.search(text)
    return (WORD_OR_CHARACTER if unspaced else WORD).findall(text.lower())


def shingles(text: str | None) -> np.ndarray:
    """A 64-bit hash of every shingle, in the order of the text."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    known = kept("bags", _Hashes)
    own = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = mix(total * GOLDEN + own[k : k + len(total)])
    return total


def digest_of(text: str | None, own: np.ndarray, counts: np.ndarray) -> bytes:
    """Equal for equal bags; a text without words has that of its characters."""
    if not len(own):
        return xxhash.xxh3_128_digest(b"text" + (text or "").encode())
    return xxhash.xxh3_128_digest(own.tobytes() + counts.astype(np.int64).tobytes())


def elements(text: str | None) -> np.ndarray:
    """The bag as a set: the k-th copy of a shingle is an element of its own."""
    return numbered(np.sort(shingles(text)))


def numbered(own: np.ndarray) -> np.ndarray:
    """An element for each of the sorted shingles ``own`` and its number among its equals."""
    first = np.concatenate([[True], own[1:] != own[:-1]])[: len(own)]
    at = np.flatnonzero(first)
    copy = np.arange(len(own)) - np.repeat(at, np.diff(np.append(at, len(own))))
    return mix(own + copy.astype(np.uint64) * GOLDEN)


def signatures(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, bags: int) -> np.ndarray:
    """bags x SIZE first times; ``owner`` numbers the bag of each (shingle, weight)."""
    # intervals [0, 1), [1, 2), [2, 4), ... of each shingle, up to its weight
    levels = np.ceil(np.log2(weight)).astype(np.int64) + 1
    item = np.repeat(np.arange(len(owner)), levels)
    level = np.arange(len(item)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    rate = np.where(level > 0, 2.0 ** (level - 1), 1.0)
    seed = mix(shingle[item] + mix(level.astype(np.uint64) + GOLDEN))
    bag, upto = owner[item], (weight[item] - low) / rate

    times = np.full((bags, SIZE), np.inf)
    until = SIZE * (np.log(SIZE) + 3) / np.maximum(np.bincount(owner, weight, bags), 1)
    todo = np.bincount(owner, minlength=bags) > 0
    while todo.any():
        on = np.flatnonzero(todo[bag])
        clock, step = np.zeros(len(on)), 0
        while len(on):
            step += 1
            draw = mix(seed[on] + np.uint64(step * int(GOLDEN) % 2**64))
            clock = clock - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) / 2.0**53) / rate[on]
            alive = clock <= until[bag[on]]
            on, clock, draw = on[alive], clock[alive], draw[alive]
            more = mix(draw + GOLDEN)
            place = (more >> np.uint64(32)).astype(float) / 2.0**32
            component = ((more & np.uint64(0xFFFFFFFF)) * np.uint64(SIZE)) >> np.uint64(32)
            inside = place < upto[on]
            np.minimum.at(times, (bag[on][inside], component[inside].astype(np.int64)), clock[inside])
        todo &= np.isinf(times).any(axis=1)
        until[todo] *= 2
    return times


def bands_of(times: np.ndarray) -> np.ndarray:
    """bags x BANDS 64-bit hashes of the bands."""
    bits = times.view(np.uint64).reshape(len(times), BANDS, ROWS)
    total = np.arange(BANDS, dtype=np.uint64)[None, :] * GOLDEN
    for k in range(ROWS):
        total = mix(total + bits[:, :, k])
    return total.view(np.int64)


def sign_texts(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, list[np.ndarray]]:
    """Digest of the bag, its size and its bands, for each text; equal texts are signed once."""
    different = {t: i for i, t in enumerate(dict.fromkeys(t or "" for t in texts))}
    digests, sizes, bands = [b""] * len(different), np.zeros(len(different), np.int64), []
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def sign_held() -> None:
        if held:
            owner = np.repeat(np.arange(len(held)), [len(h) for h, _ in held])
            got = bands_of(signatures(owner, np.concatenate([h for h, _ in held]),
                                      np.concatenate([w for _, w in held]).astype(float), len(held)))
            bands.extend(g if len(h) else g[:0] for g, (h, _) in zip(got, held))
            held.clear()

    waiting = 0
    for text, i in different.items():
        own, counts = np.unique(shingles(text), return_counts=True)
        digests[i] = digest_of(text, own, counts)
        sizes[i] = counts.sum()
        if waiting + len(own) > BATCH:
            sign_held()
            waiting = 0
        held.append((own, counts))
        waiting += len(own)
    sign_held()
    at = [different[t or ""] for t in texts]
    return [digests[i] for i in at], sizes[at], [bands[i] for i in at]


def copy_of(text: str) -> Column:
    """A digest of the text itself; null is empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def signed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, copy (digest of the text), digest (of its bag), size, bands of every row."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            digest, size, bands = sign_texts(frame["text"].tolist())
            yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "copy": frame["copy"].to_numpy(),
                                "digest": digest, "size": size, "bands": bands})

    kind = docs.schema[doc_id].dataType.simpleString()
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), copy_of(text).alias("copy"))
    return in_small_batches(own).mapInPandas(
        run, f"doc_id {kind}, copy binary, digest binary, size long, bands array<long>")


def bags(texts: DataFrame) -> DataFrame:
    """node, own: the bag of each text as a set of 64-bit elements.

    ``texts`` has the nodes (digests) that are wanted with the texts under a doc_id that has
    them; other texts under that doc_id give nothing.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            nodes, own = [], []
            for node, text in zip(frame["node"], frame["text"]):
                sorted_ = np.sort(shingles(text))
                if digest_of(text, *np.unique(sorted_, return_counts=True)) == bytes(node):
                    nodes.append(node)
                    own.append(numbered(sorted_).view(np.int64))
            if nodes:
                yield pd.DataFrame({"node": nodes, "own": own})

    return in_small_batches(texts).select("node", "text").mapInPandas(
        run, "node binary, own array<long>").dropDuplicates(["node"])


def _members(nodes: DataFrame) -> DataFrame:
    """bucket, node, size, rank: the nodes of every bucket that has more than one."""
    dealt = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    shared = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    return number_within(dealt.join(shared, "bucket"), "bucket", ["node"], "rank", buckets=64)


def verified(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """a, b, similarity of every pair."""
    right = own.select(F.col("node").alias("b"), F.col("own").alias("own_b"))
    left = own.select(F.col("node").alias("a"), F.col("own").alias("own_a"))
    both = F.size(F.array_intersect("own_a", "own_b"))
    return (
        pairs.join(right, "b").join(left, "a")
        .withColumn("both", both)
        .select("a", "b", (F.col("both") / (F.size("own_a") + F.size("own_b") - F.col("both")))
                .alias("similarity"))
    )


def _sizes_fit(a: str, b: str, similarity: float):
    return F.least(a, b) >= similarity * F.greatest(a, b)


def classified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, copy, root, class_id of every row; the class id is the smallest doc_id of the class.

    Nodes are bags, by their digests, whatever the doc_ids of their rows.
    """
    rows = stage(signed(docs, doc_id, text), "bag-signatures")
    nodes = stage(
        rows.groupBy(F.col("digest").alias("node")).agg(
            F.min("doc_id").alias("least"), F.first("size").alias("size"),
            F.first("bands").alias("bands")),
        "bag-nodes",
    )
    members = stage(_members(nodes.where("least IS NOT NULL")), "bag-members")
    candidates = members.select("node").distinct().join(nodes.select("node", "least"), "node")
    texts = docs.select(F.col(doc_id).alias("least"), F.col(text).alias("text"))
    own = stage(bags(attach(texts, stage(candidates, "bag-candidates"), ["least"], "inner")), "bags")

    first = members.where("rank = 0").select("bucket", F.col("node").alias("first"),
                                             F.col("size").alias("first_size"))
    star = members.where("rank > 0").join(first, "bucket")
    begun = stage(
        verified(
            star.where(_sizes_fit("size", "first_size", similarity))
            .select(F.least("first", "node").alias("a"), F.greatest("first", "node").alias("b"))
            .distinct(), own),
        "bag-star")
    links = components(begun.where(F.col("similarity") >= similarity).select("a", "b"))

    links = components(links.select("a", "b").unionByName(
        stray_links(members, links, own, similarity)))
    return _classes_of(rows, nodes, links)


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id of every row."""
    return classified(docs, doc_id, text, similarity).select("doc_id", "class_id")


def one_of_each_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      similarity: float = SIMILARITY) -> DataFrame:
    """One text of each class: its smallest doc_id's, and of texts under that one the first digest's.

    Rows without doc_id stay, and rows that repeat both doc_id and text stay or go together.
    """
    found = stage(classified(docs, doc_id, text, similarity).where("doc_id IS NOT NULL"), "bag-classes")
    texts = found.select("doc_id", "root", "class_id", "copy").distinct()
    heads = texts.where("doc_id = class_id").groupBy("root").agg(F.min("copy").alias("head"))
    gone = stage(
        texts.join(heads, "root").where("doc_id <> class_id OR copy <> head").select("doc_id", "copy"),
        "bag-gone")
    mark = "_" * (1 + max(map(len, docs.columns)))  # no column of docs has this name
    side = gone.toDF(f"{mark}i", f"{mark}c")
    if gone.count() <= BROADCAST_ROWS:
        side = F.broadcast(side)
    same = (F.col(doc_id) == F.col(f"{mark}i")) & (copy_of(text) == F.col(f"{mark}c"))
    return docs.join(side, same, "left_anti")


def _classes_of(rows: DataFrame, nodes: DataFrame, links: DataFrame) -> DataFrame:
    roots = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    rooted = stage(
        nodes.select("node", "least").join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node")), "bag-rooted")
    ids = rooted.groupBy("root").agg(F.min("least").alias("class_id"))
    placed = rooted.join(ids, "root").select(F.col("node").alias("digest"), "root", "class_id")
    return rows.select("doc_id", "copy", "digest").join(placed, "digest").select(
        "doc_id", "copy", "root", "class_id")


def link_blocks(strays: pd.DataFrame, nodes: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """One link of each stray to each other root, among two blocks of a bucket."""
    sizes = nodes["own"].map(len).to_numpy()
    flat = np.concatenate(nodes["own"].to_list())
    owner = np.repeat(np.arange(len(nodes)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    roots, names, out = nodes["root"].to_numpy(), nodes["node"].to_numpy(), []
    for node, root, bag in zip(strays["node"], strays["root"], strays["own"]):
        low, high = np.searchsorted(flat, bag, "left"), np.searchsorted(flat, bag, "right")
        many = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        both = np.bincount(owner[at], minlength=len(nodes))
        near = (roots != root) & (both >= similarity * (sizes + len(bag) - both) - 1e-9)
        _, one = np.unique(roots[near], return_index=True)
        out.extend((min(node, x), max(node, x)) for x in names[near][one])
    return pd.DataFrame(out, columns=["a", "b"])


def stray_links(members: DataFrame, links: DataFrame, own: DataFrame, similarity: float) -> DataFrame:
    """Links between nodes of a bucket that are in different components so far."""
    roots = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    now = stage(members.select("bucket", "node").join(roots, "node", "left")
                .withColumn("root", F.coalesce("root", "node")), "bag-roots")
    parts = now.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    open_ = (
        parts.groupBy("bucket")
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("roots"),
             F.max(F.struct("n", "root")).alias("largest"))
        .where("roots > 1")
        .select("bucket", F.col("largest.root").alias("main"),
                F.ceil((F.col("n") - F.col("largest.n")) / STRAY_BLOCK).cast("int").alias("stray_blocks"),
                F.ceil(F.col("n") / NODE_BLOCK).cast("int").alias("node_blocks"))
    )
    placed = stage(now.join(open_, "bucket"), "bag-open")
    if placed.isEmpty():
        return links.select("a", "b").limit(0)

    def block(blocks: str):
        return F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")

    def every(blocks: str):
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    key = ["bucket", "s", "m"]
    # aliases keep the columns of the two sides apart
    columns = [F.col(c).alias(c) for c in (*key, "node", "root", "own")]
    strays = placed.where("root <> main").withColumn("s", block("stray_blocks")).withColumn(
        "m", every("node_blocks")).join(own, "node").select(*columns)
    nodes = placed.withColumn("m", block("node_blocks")).withColumn(
        "s", every("stray_blocks")).join(own, "node").select(*columns)
    kind = members.schema["node"].dataType.simpleString()

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []})
        return link_blocks(left, right, similarity)

    found = strays.groupBy(*key).cogroup(nodes.groupBy(*key)).applyInPandas(compare, f"a {kind}, b {kind}")
    return found.distinct()
