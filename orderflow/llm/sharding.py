"""Sharding by best-fit-decreasing bin packing.

Groups (rows of equal text, which stay together) go by falling size into the shard
with the tightest remaining capacity that holds them; a balanced tree of remaining
capacities finds it. A new shard is opened where none fits.

Packing needs only how many groups there are of each size. Sizes above 2,048 are
rounded up to 11 leading bits, at most 0.1 % more, so there are less than 60,000
sizes whatever the data; this table alone comes to the driver. It answers which
ranks of each size go to which shard; ranks are given by Spark. For a wanted number
of shards the least capacity that suffices is searched by bisection.

Shuffled are short rows (id, size, hash), never texts.

Defined cases: null text counts as 0 bytes and is a group apart from empty text; a
group larger than the capacity gets a shard of its own; repeated rows are rows like
others; an empty table has no shards.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import attach, number_within, utf8_size
from orderflow.session import stage

LEADING_BITS = 11


@dataclass
class _Node:
    key: tuple[int, int]
    left: _Node | None = None
    right: _Node | None = None
    height: int = 1


class BalancedTree:
    """Ordered set of (remaining capacity, shard), kept balanced by height."""

    def __init__(self) -> None:
        self.root: _Node | None = None

    def ceiling(self, key: tuple[int, int]) -> tuple[int, int] | None:
        """The smallest member that is not below ``key``."""
        node, best = self.root, None
        while node:
            if node.key >= key:
                node, best = node.left, node.key
            else:
                node = node.right
        return best

    def add(self, key: tuple[int, int]) -> None:
        self.root = self._add(self.root, key)

    def remove(self, key: tuple[int, int]) -> None:
        self.root = self._remove(self.root, key)

    def _add(self, node, key):
        if node is None:
            return _Node(key)
        if key < node.key:
            node.left = self._add(node.left, key)
        else:
            node.right = self._add(node.right, key)
        return self._level(node)

    def _remove(self, node, key):
        if key < node.key:
            node.left = self._remove(node.left, key)
        elif key > node.key:
            node.right = self._remove(node.right, key)
        elif node.left is None or node.right is None:
            return node.left or node.right
        else:
            after = node.right
            while after.left:
                after = after.left
            node.key = after.key
            node.right = self._remove(node.right, after.key)
        return self._level(node)

    @staticmethod
    def _tall(node) -> int:
        return node.height if node else 0

    def _measure(self, node):
        node.height = 1 + max(self._tall(node.left), self._tall(node.right))
        return node

    def _turn(self, node, up, down):
        child = getattr(node, up)
        setattr(node, up, getattr(child, down))
        setattr(child, down, self._measure(node))
        return self._measure(child)

    def _level(self, node):
        self._measure(node)
        lean = self._tall(node.left) - self._tall(node.right)
        if abs(lean) < 2:
            return node
        up, down = ("left", "right") if lean > 0 else ("right", "left")
        child = getattr(node, up)
        if self._tall(getattr(child, down)) > self._tall(getattr(child, up)):
            setattr(node, up, self._turn(child, down, up))
        return self._turn(node, up, down)


def best_fit(sizes: Iterable[tuple[int, int]], capacity: int,
             most: int | None = None) -> list[tuple[int, int, int]] | None:
    """(size, shard, groups) for (size, groups), largest first.

    Groups of one size go to the tightest shard until it holds no more, as they
    would one by one. None if more than ``most`` shards are needed.
    """
    tree, plan, shards = BalancedTree(), [], 0
    for size, groups in sizes:
        while groups:
            found = tree.ceiling((size, -1))
            if found:
                tree.remove(found)
                left, shard = found
                put = min(groups, left // size)
            else:
                if most is not None and shards == most:
                    return None
                left, shard, shards = max(capacity, size), shards, shards + 1
                put = min(groups, left // size)
            plan.append((size, shard, put))
            groups -= put
            tree.add((left - put * size, shard))
    return plan


def pack(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """The plan of the least capacity with which best fit needs at most ``shards``."""
    ordered = sorted(sizes, reverse=True)
    if not ordered:
        return []
    total = sum(s * n for s, n in ordered)
    low = max(ordered[0][0], -(-total // shards))
    high, plan = low, best_fit(ordered, low, shards)
    while plan is None:
        low, high = high + 1, high * 2
        plan = best_fit(ordered, high, shards)
    while low < high:
        middle = (low + high) // 2
        tried = best_fit(ordered, middle, shards)
        if tried is None:
            low = middle + 1
        else:
            high, plan = middle, tried
    return plan


def shard(docs: DataFrame, shards: int | None = None, capacity: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    Give either the number of shards (equal capacities, the least that suffice) or
    their fixed capacity in bytes (as few shards as best fit needs).
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    spark = docs.sparkSession
    rows = stage(
        docs.select(
            "doc_id", (utf8_size("text") + 1).alias("size"),
            F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
            F.coalesce(F.unhex(F.sha2("text", 256)), F.lit(b"")).alias("text_key"),
        ),
        "shard-rows",
    )
    shift = f"greatest(length(bin(bytes)) - {LEADING_BITS}, 0)"
    groups = stage(
        rows.groupBy("text_key").agg(F.sum("size").alias("bytes")).withColumn("size_class", F.expr(
            f"shiftleft(shiftright(bytes + shiftleft(1L, {shift}) - 1, {shift}), {shift})")),
        "shard-groups",
    )
    counted = groups.groupBy("size_class").agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = [(r["size_class"], r["n"]) for r in counted]
    plan = pack(sizes, shards) if shards else best_fit(sorted(sizes, reverse=True), capacity)
    ends: dict[int, list[tuple[int, int]]] = {}
    for size, number, put in plan:
        own = ends.setdefault(size, [])
        own.append(((own[-1][0] if own else 0) + put, number))
    chosen = spark.createDataFrame(
        list(ends.items()), "size_class long, ends array<struct<upto:long,shard:int>>")
    ranked = number_within(groups.select("text_key", "size_class"), "size_class", ["text_key"], "rank")
    placed = stage(
        # one row per size, less than 60,000
        ranked.join(F.broadcast(chosen), "size_class")
        .select("text_key", F.expr("filter(ends, e -> rank < e.upto)[0].shard").alias("shard")),
        "shard-groups-placed",
    )
    dealt = attach(rows, placed, ["text_key"], "inner")
    return number_within(dealt, "shard", ["doc_id", "text_key"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
