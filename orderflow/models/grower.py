"""Forests grown from binned rows, with memory of a task that does not grow with the rows.

Spark's own forest keeps each row with its draws and nodes of all trees, spills them to disk
on large inputs, and adds every row to the sums of both values of every one-hot slot. Here
rows are binned once and staged: one small number for each category column or numeric
feature, or for several of them that have few values together, the target, and a hash for the
draws. Each task grows some of the trees and reads all rows for them. Sums of a node are kept
by category value instead of slot; those of a slot's other value are the rest of the node's.

Up to ``KEEP_ROWS`` rows a task keeps the binned rows and grows its trees one by one, in one
job. Above, each level is one job, in which a task reads the rows in blocks and walks each
block to its nodes, so that it holds a block and the sums of one level, whatever the rows.

Splits are chosen as Spark chooses them: the greatest gain, the feature that comes first on
a tie, then the smallest threshold; a node of one value or without gain is a leaf, and leaves
of one parent that predict the same are one. The model is written in the format in which
Spark stores forests, and read by Spark.
"""

from __future__ import annotations

import json
import math
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.models.encoding import CategoryModel
from orderflow.session import delete, staged_path

#: Rows that a task keeps, with some 25 bytes each; more are read again for every level.
KEEP_ROWS = 4_000_000
#: Rows of a block that are walked and added up at once.
BLOCK_ROWS = 1_000_000
#: Features share a number as long as it has at most so many values.
CELL_BINS = 256
#: Sums of a level that are compared at once.
SUMS_AT_ONCE = 4_000_000
#: Sums that a task holds, 128 MB; a level with more is added up in parts of its nodes.
SUMS_OF_TASK = 16_000_000
#: Tasks for each one that runs at once, so that a slow one is not waited for long.
TASKS_FOR_ONE = 2
#: A node whose impurity is below is a leaf, as in Spark.
PURE = 2.0**-52
#: Accuracy of the quantiles that cut features of many values.
QUANTILE_ACCURACY = 10_000

NODES = (
    "treeID int, nodeData struct<id:int,prediction:double,impurity:double,"
    "impurityStats:array<double>,rawCount:bigint,gain:double,leftChild:int,rightChild:int,"
    "split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>"
)


@dataclass(frozen=True)
class Feature:
    """A category column with ``bins - 1`` slots and one bin for other values, or a numeric
    feature with ``bins - 1`` thresholds. It starts at ``index`` in Spark's vector, and its bin
    is ``code // step % bins`` of the code in ``cell``."""

    index: int
    bins: int
    cuts: np.ndarray | None
    cell: int = 0
    step: int = 1

    @property
    def splits(self) -> int:
        return self.bins - 1

    @property
    def slots(self) -> int:
        return 1 if self.cuts is not None else self.splits


@dataclass(frozen=True)
class Recipe:
    """What the workers need to grow trees; ``classes`` is 0 for a regression."""

    features: tuple[Feature, ...]
    cell_bins: tuple[int, ...]
    classes: int
    depth: int
    seed: int
    bootstrap: bool
    exact: bool
    tried: int
    block_rows: int = BLOCK_ROWS
    sums: int = SUMS_OF_TASK
    compared: int = SUMS_AT_ONCE
    widest: int = CELL_BINS

    @property
    def width(self) -> int:
        return sum(f.slots for f in self.features)

    @property
    def stats(self) -> int:
        """Sums of a bin: by class, or rows and targets, and their squares where gains are compared with SQL."""
        return self.classes or (3 if self.exact else 2)


@dataclass
class Level:
    """Nodes of one depth of a tree. Children of the j-th split are nodes 2j and 2j + 1 below."""

    totals: np.ndarray
    gain: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    _walks: tuple | None = field(default=None, repr=False)

    def walks(self, recipe: Recipe) -> tuple[np.ndarray, ...]:
        """Cell of every node, where its table starts, first child, and the tables of sides.

        A node that splits a cell of many bins has no table; its start is -1.
        """
        if self._walks is None:
            split = self.feature >= 0
            child = np.where(split, 2 * (np.cumsum(split) - 1), -1)
            cell, start, tables, at = np.zeros(len(split), np.int64), np.zeros(len(split), np.int64), [], 0
            for j in np.flatnonzero(split):
                f = recipe.features[self.feature[j]]
                cell[j], bins = f.cell, recipe.cell_bins[f.cell]
                if bins > recipe.widest:
                    start[j] = -1
                    continue
                tables.append(self._right(f, j, np.arange(bins) // f.step % f.bins))
                start[j], at = at, at + bins
            sides = np.concatenate(tables) if tables else np.zeros(1, bool)
            numeric = np.array([f.cuts is not None for f in recipe.features], bool)[self.feature]
            self._walks = cell, start, child, sides.view(np.int8), numeric
        return self._walks

    def _right(self, f: Feature, node: int, own: np.ndarray) -> np.ndarray:
        """Which bins of the feature go right from the node."""
        if f.cuts is not None:
            return own > self.cut[node]
        return (own == self.cut[node]) != (self.left[node] == 1)

    @staticmethod
    def joined(parts: list[Level]) -> Level:
        """One level from parts of its nodes."""
        whole = [np.concatenate([getattr(p, n) for p in parts], -1) for n in ("totals", "gain", "feature", "cut", "left")]
        return Level(*whole)


def walk(recipe: Recipe, level: Level, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Nodes of the next level to which rows in nodes ``at`` go; -1 from leaves."""
    cell, start, child, sides, numeric = level.walks(recipe)
    n = codes.shape[1]
    place = cell.take(at)
    place *= n
    place += np.arange(n)
    code = codes.ravel().take(place)
    first = child.take(at)
    spot = start.take(at)
    wide = np.flatnonzero(spot < 0)
    spot += code
    spot[first < 0] = 0
    spot[wide] = 0
    below = first + sides.take(spot)
    if len(wide):
        nodes, code = at[wide], code[wide]
        one = (code == level.cut[nodes]) != (level.left[nodes] == 1)
        below[wide] = first[wide] + np.where(numeric[nodes], code > level.cut[nodes], one)
    below[first < 0] = -1
    return below


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """Even 32-bit numbers from ``x`` and a key."""
    x = x ^ np.uint32(key & 0xFFFFFFFF)
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    return x ^ (x >> np.uint32(16))


#: A draw counts as often as its 32-bit number reaches one of these: Poisson with mean 1.
_DRAWS = [
    np.uint32(int(min(p, 1.0) * 2**32))
    for p in np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    if int(min(p, 1.0) * 2**32) < 2**32
]


def draws(recipe: Recipe, tree: int, hashes: np.ndarray) -> np.ndarray:
    """How often each row is drawn for a tree; fixed by the row, the tree and the seed."""
    if not recipe.bootstrap:
        return np.ones(len(hashes), np.int8)
    keys = np.random.default_rng([recipe.seed, tree]).integers(2**32, size=2)
    even = _mixed(_mixed(hashes, int(keys[0])), int(keys[1]))
    times = np.zeros(len(hashes), np.int8)
    for bound in _DRAWS:
        times += even >= bound
    return times


class Sums:
    """Sums over the rows of each node of a level: in all, and by bin of each cell."""

    def __init__(self, recipe: Recipe, nodes: int, by_bin: bool):
        self.recipe, self.nodes = recipe, nodes
        self.totals = np.zeros((recipe.classes or 3, nodes))
        cells = recipe.cell_bins if by_bin else ()
        self.cells = [np.zeros((recipe.stats, nodes, b)) for b in cells]

    def add(self, codes: np.ndarray, at: np.ndarray, times: np.ndarray, y: np.ndarray) -> None:
        if self.recipe.classes:
            parts = [times * (y == k) for k in range(self.recipe.classes)]
        else:
            parts = [times, times * y, times * y * y]
        for total, part in zip(self.totals, parts, strict=True):
            total += np.bincount(at, part, self.nodes)
        for cell, code in zip(self.cells, codes, strict=False):
            bins = cell.shape[2]
            place = at * np.int64(bins)
            place += code
            for sums, part in zip(cell, parts, strict=False):
                sums += np.bincount(place, part, self.nodes * bins).reshape(sums.shape)


    def join(self, other: Sums) -> None:
        """Add the sums over other rows."""
        self.totals += other.totals
        for cell, more in zip(self.cells, other.cells, strict=True):
            cell += more


def _impurity(recipe: Recipe, sums: np.ndarray) -> np.ndarray:
    """Of sums by class, or of rows, targets and squares."""
    if recipe.classes:
        n = sums.sum(0)
        whole = np.ones_like(n)
        for c in sums:
            whole = whole - (c / n) * (c / n)
        return whole
    n, s, q = sums
    return (q - (s * s) / n) / n


def _gains(recipe: Recipe, totals: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Gain of every split with the sums ``left`` (stats, nodes, splits); invalid ones have none."""
    whole = totals[: recipe.stats, :, None]
    right = whole - left
    count = (lambda sums: sums.sum(0)) if recipe.classes else (lambda sums: sums[0])
    n, ln, rn = count(whole), count(left), count(right)
    with np.errstate(divide="ignore", invalid="ignore"):
        if recipe.stats == 2 and not recipe.classes:
            gain = (left[1] ** 2 / ln + right[1] ** 2 / rn - whole[1] ** 2 / n) / n
        else:
            gain = (
                _impurity(recipe, whole)
                - (ln / n) * _impurity(recipe, left)
                - (rn / n) * _impurity(recipe, right)
            )
    return np.where((ln >= 1) & (rn >= 1), gain, -np.inf)


def _center(recipe: Recipe, sums: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return sums[1] / (sums[0] + sums[1]) if recipe.classes else sums[1] / sums[0]


def nodes_at_once(recipe: Recipe) -> int:
    """Nodes of a tree whose sums a task holds at once; one at least."""
    return max(1, recipe.sums // (recipe.stats * sum(recipe.cell_bins)))


def chosen(recipe: Recipe, tree: int, depth: int, sums: Sums, begin: int = 0) -> Level:
    """The best split of every node of ``sums``, which start with the node ``begin`` of their level."""
    nodes, totals = sums.nodes, sums.totals
    gain, feature = np.zeros(nodes), np.full(nodes, -1)
    cut, left_value = np.zeros(nodes, np.int64), np.zeros(nodes, np.int8)
    if not sums.cells:
        return Level(totals, gain, feature, cut, left_value)
    asked = None
    if recipe.tried < recipe.width:
        lots = np.random.default_rng([recipe.seed, tree, depth]).random((begin + nodes, recipe.width))[begin:]
        asked = lots <= np.partition(lots, recipe.tried - 1, 1)[:, recipe.tried - 1 : recipe.tried]
    shapes = _shapes(recipe)
    step = max(1, recipe.compared // max(recipe.cell_bins))
    for first in range(0, nodes, step):
        some = slice(first, first + step)
        whole = totals[:, some]
        for i, f in enumerate(recipe.features):
            axes, keep = shapes[i]
            own = sums.cells[f.cell][:, some].reshape(recipe.stats, whole.shape[1], *axes)
            own = own.sum(tuple(2 + a for a in range(len(axes)) if a != keep))[:, :, : f.bins]
            if f.cuts is not None:
                left, ones = own.cumsum(2)[:, :, :-1], None
            else:
                own = own[:, :, :-1]
                rest = whole[: recipe.stats, :, None] - own
                # Categories are ordered by their mean; with more classes they are not.
                ones = np.zeros(own.shape[1:], bool)
                if recipe.classes <= 2:
                    ones = _center(recipe, own) < _center(recipe, rest)
                left = np.where(ones, own, rest)
            if not left.shape[2]:
                continue
            gains = _gains(recipe, whole, left)
            if asked is not None:
                gains = np.where(asked[some, f.index : f.index + f.slots], gains, -np.inf)
            best = gains.argmax(1)
            value = gains[np.arange(len(best)), best]
            better = value > gain[some]
            gain[some][better] = value[better]
            feature[some][better] = i
            cut[some][better] = best[better]
            if ones is not None:
                left_value[some][better] = ones[np.arange(len(best)), best][better]
    rows = totals.sum(0) if recipe.classes else totals[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        leaf = (rows < 2) | (np.abs(_impurity(recipe, totals)) < PURE)
    feature[leaf] = -1
    return Level(totals, gain, feature, cut, left_value)


def _shapes(recipe: Recipe) -> list[tuple[tuple[int, ...], int]]:
    """For each feature the bins of the features in its cell, slowest first, and its own place."""
    shapes = []
    for f in recipe.features:
        inside = sorted((g for g in recipe.features if g.cell == f.cell), key=lambda g: -g.step)
        shapes.append((tuple(g.bins for g in inside), inside.index(f)))
    return shapes


def grown(recipe: Recipe, tree: int, codes: np.ndarray, y: np.ndarray, hashes: np.ndarray) -> list[Level]:
    """All levels of a tree, from rows that are kept."""
    times = draws(recipe, tree, hashes)
    alive = times > 0
    codes, y, times = codes[:, alive], y[alive], times[alive].astype(float)
    at, levels, nodes = np.zeros(len(y), np.int64), [], 1
    while nodes:
        depth, step, parts = len(levels), nodes_at_once(recipe), []
        for begin in range(0, nodes, step):
            sums = Sums(recipe, min(step, nodes - begin), depth < recipe.depth)
            if nodes <= step:
                sums.add(codes, at, times, y)
            else:
                own = (at >= begin) & (at < begin + step)
                sums.add(codes[:, own], at[own] - begin, times[own], y[own])
            parts.append(chosen(recipe, tree, depth, sums, begin))
        levels.append(Level.joined(parts))
        nodes = _below(levels)
        if nodes:
            at = walk(recipe, levels[-1], codes, at)
            alive = at >= 0
            if not alive.all():
                codes, y, times, at = codes[:, alive], y[alive], times[alive], at[alive]
    return levels


def _below(levels: list[Level]) -> int:
    """Nodes of the level after these."""
    return 2 * int((levels[-1].feature >= 0).sum()) if levels else 1


def _blocks(batches: Iterator[pa.RecordBatch], cells: int, rows: float) -> Iterator[tuple]:
    """Codes, targets and hashes of at least ``rows`` rows at a time."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield _arrays(held, cells)
            held, n = [], 0
    if n:
        yield _arrays(held, cells)


def _arrays(batches: list[pa.RecordBatch], cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    columns = [
        np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in batches])
        for i in range(batches[0].num_columns - 1)
    ]
    codes = np.stack(columns[:cells]) if cells else np.zeros((0, len(columns[-1])), np.uint8)
    if codes.size and codes.max() < 256:
        codes = codes.astype(np.uint8)
    return codes, columns[cells], columns[cells + 1].view(np.uint32)


def _peeked(batches: Iterator[pa.RecordBatch]) -> tuple[int | None, Iterator[pa.RecordBatch]]:
    """The group of trees of this task, which stands in the last column, and all batches."""
    for first in batches:
        if first.num_rows:
            def all_batches():
                yield first
                yield from batches

            return first.column(first.num_columns - 1)[0].as_py(), all_batches()
    return None, iter(())


def _group(recipe: Recipe, trees: int, tasks: int, group: int) -> range:
    return range(group, trees, tasks)


def keep_and_grow(recipe: Recipe, trees: int, tasks: int):
    """A task that keeps all rows and gives the nodes of its trees."""
    def work(batches):
        group, batches = _peeked(batches)
        for codes, y, hashes in _blocks(batches, len(recipe.cell_bins), math.inf):
            for tree in _group(recipe, trees, tasks, group):
                yield node_rows(recipe, tree, grown(recipe, tree, codes, y, hashes))

    return work


def add_level(
    recipe: Recipe, trees: int, tasks: int, so_far: list[list[Level] | None], begin: int, in_part: bool
):
    """A task that reads rows by block and gives, from node ``begin`` on, the next level of its
    trees, or its rows' part of the sums."""
    def work(batches):
        group, batches = _peeked(batches)
        if group is None:
            return
        step, sums = nodes_at_once(recipe), {}
        for t in _group(recipe, trees, tasks, group):
            if so_far[t] is not None and _below(so_far[t]) > begin:
                sums[t] = Sums(recipe, min(step, _below(so_far[t]) - begin), len(so_far[t]) < recipe.depth)
        for codes, y, hashes in _blocks(batches, len(recipe.cell_bins), recipe.block_rows):
            for t in sums:
                times = draws(recipe, t, hashes)
                alive = np.flatnonzero(times)
                own, at = codes[:, alive], np.zeros(len(alive), np.int64)
                for level in so_far[t]:
                    at = walk(recipe, level, own, at)
                    if (ended := at < 0).any():
                        kept = ~ended
                        own, at, alive = own[:, kept], at[kept], alive[kept]
                if _below(so_far[t]) > step:
                    kept = (at >= begin) & (at < begin + step)
                    own, at, alive = own[:, kept], at[kept] - begin, alive[kept]
                sums[t].add(own, at, times[alive].astype(float), y[alive])
        for t in list(sums):
            found = sums.pop(t)
            if not in_part:
                found = chosen(recipe, t, len(so_far[t]), found, begin)
            yield pa.RecordBatch.from_pydict(
                {"tree": pa.array([t], pa.int32()), "found": pa.array([pickle.dumps(found)], pa.binary())}
            )

    return work


def node_rows(recipe: Recipe, tree: int, levels: list[Level]) -> pa.RecordBatch:
    """Nodes of a tree as Spark stores them, level by level, so that children come later."""
    ends = []  # nodes that stay as they are, or become leaves, from the lowest level up
    stats = [lv.totals for lv in levels]
    value = [s.argmax(0).astype(float) if recipe.classes else s[1] / s[0] for s in stats]
    split = [lv.feature >= 0 for lv in levels]
    for d in range(len(levels) - 2, -1, -1):
        at = np.flatnonzero(split[d])
        low = np.arange(len(at)) * 2
        same = (
            ~split[d + 1][low] & ~split[d + 1][low + 1] & (value[d + 1][low] == value[d + 1][low + 1])
        )
        split[d][at[same]] = False
    there = [np.ones(1, bool)]
    for d in range(len(levels) - 1):
        # children were numbered before leaves were joined
        parents = np.flatnonzero(levels[d].feature >= 0)
        there.append(np.repeat(split[d][parents] & there[d][parents], 2))
    ids, at = [], 0
    for alive in there:
        ids.append(np.where(alive, at + np.cumsum(alive) - 1, -1))
        at += int(alive.sum())
    columns = []
    for d, alive in enumerate(there):
        own, lv = np.flatnonzero(alive), levels[d]
        inner = split[d][own]
        child = np.full(len(own), -1)
        if inner.any():
            order = np.cumsum(lv.feature >= 0) - 1
            child[inner] = ids[d + 1][2 * order[own[inner]]]
        columns.append((ids[d][own], own, inner, child, np.full(len(own), d)))
    id_, own, inner, child, depth = (np.concatenate(c) for c in zip(*columns, strict=True))
    pick = lambda arrays: np.concatenate([a[..., i] for a, i in zip(arrays, _by(depth, own, len(levels)), strict=True)], -1)
    totals, feature = pick(stats), np.where(inner, pick([lv.feature for lv in levels]), -1)
    cut, left, gain = (pick([getattr(lv, n) for lv in levels]) for n in ("cut", "left", "gain"))
    index, given, kinds = [], [], []
    for f, c, side in zip(feature, cut, left, strict=True):
        own_feature = recipe.features[f] if f >= 0 else None
        if own_feature is None:
            index.append(-1), given.append([]), kinds.append(-1)
        elif own_feature.cuts is not None:
            index.append(own_feature.index), given.append([float(own_feature.cuts[c])]), kinds.append(-1)
        else:
            index.append(own_feature.index + int(c)), given.append([float(side)]), kinds.append(2)
    rows = totals.sum(0) if recipe.classes else totals[0]
    split_array = pa.StructArray.from_arrays(
        [pa.array(index, pa.int32()), pa.array(given, pa.list_(pa.float64())), pa.array(kinds, pa.int32())],
        ["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
    )
    data = pa.StructArray.from_arrays(
        [
            pa.array(id_, pa.int32()),
            pa.array(pick(value), pa.float64()),
            pa.array(_impurity(recipe, totals), pa.float64()),
            pa.array(list(totals.T), pa.list_(pa.float64())),
            pa.array(rows.astype(np.int64), pa.int64()),
            pa.array(np.where(inner, gain, -1.0), pa.float64()),
            pa.array(child, pa.int32()),
            pa.array(np.where(inner, child + 1, -1), pa.int32()),
            split_array,
        ],
        ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"],
    )
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(id_), tree), pa.int32()), data], ["treeID", "nodeData"])


def _by(depth: np.ndarray, own: np.ndarray, levels: int) -> list[np.ndarray]:
    return [own[depth == d] for d in range(levels)]


# --- binning --------------------------------------------------------------------------------


def thresholds(rows: DataFrame, numeric: Sequence[str], bins: int) -> list[np.ndarray]:
    """Midpoints between all values of features with up to ``bins`` values, else quantiles.

    All rows are read. Only values of features with few of them pass the driver.
    """
    if not numeric:
        return []
    numbers = rows.select(*[F.col(c).cast("double").alias(c) for c in numeric])
    about = numbers.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in numeric]).first()
    few = [c for c in numeric if about[c] <= 1.2 * bins + 10]
    cuts: dict[str, np.ndarray] = {}
    if few:
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in few]))
        values = numbers.select(cells.alias("cell")).select("cell.*").distinct().toPandas()
        for c in few:
            own = np.sort(values.loc[values["c"] == c, "v"].dropna().unique())
            if len(own) <= bins:
                cuts[c] = (own[:-1] + own[1:]) / 2
    many = [c for c in numeric if c not in cuts]
    if many:
        shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
        found = numbers.agg(
            *[F.percentile_approx(c, shares, max(QUANTILE_ACCURACY, 4 * bins)).alias(c) for c in many]
        ).first()
        cuts |= {c: np.unique(found[c]) for c in many}
    return [cuts[c] for c in numeric]


def _packed(features: Sequence[Feature]) -> tuple[tuple[Feature, ...], tuple[int, ...]]:
    """Features with their cells: those of few bins share one."""
    cells: list[int] = []
    placed: dict[int, Feature] = {}
    for i in sorted(range(len(features)), key=lambda i: -features[i].bins):
        f = features[i]
        at = next((c for c, b in enumerate(cells) if b * f.bins <= CELL_BINS), None)
        if at is None:
            at = len(cells)
            cells.append(1)
        placed[i] = Feature(f.index, f.bins, f.cuts, at, cells[at])
        cells[at] *= f.bins
    return tuple(placed[i] for i in range(len(features))), tuple(cells)


def _binning(recipe: Recipe):
    """Rows (bin of categories, numbers, target, hash) to (codes of cells, target, hash)."""
    def work(batches):
        held, n = [], 0

        def done():
            columns = [
                np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held])
                for i in range(held[0].num_columns)
            ]
            *values, y, hashes = columns
            y = y.astype(float)
            if not np.isfinite(y).all():
                raise ValueError("a training row has no target")
            if recipe.classes and not np.isin(y, np.arange(recipe.classes)).all():
                raise ValueError("classes are whole numbers from 0")
            codes = np.zeros((len(recipe.cell_bins), len(y)), np.int64)
            for f, v in zip(recipe.features, values, strict=True):
                if f.cuts is not None:
                    v = v.astype(float)
                    if np.isnan(v).any():
                        raise ValueError("a training row lacks a number")
                    v = np.searchsorted(f.cuts, v, "left")
                codes[f.cell] += v.astype(np.int64) * f.step
            # Equal rows get draws of their own.
            hashes = hashes.astype(np.int64).astype(np.uint32)
            order = np.argsort(hashes, kind="stable")
            along = hashes[order]
            first = np.concatenate([[True], along[1:] != along[:-1]])
            place = np.arange(len(along))
            nth = place - np.maximum.accumulate(np.where(first, place, 0))
            hashes[order] = along + nth.astype(np.uint32) * np.uint32(0x9E3779B9)
            # Rows with like features reach the same nodes, whose sums stay in the cache.
            order = np.lexsort((hashes, y, *codes[::-1]))
            names = [f"c{i}" for i in range(len(codes))]
            types = [pa.int16() if b <= 2**15 else pa.int32() for b in recipe.cell_bins]
            return pa.RecordBatch.from_arrays(
                [pa.array(c[order], t) for c, t in zip(codes, types, strict=True)]
                + [pa.array(y[order], pa.float64()), pa.array(hashes[order].view(np.int32), pa.int32())],
                [*names, "y", "h"],
            )

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= recipe.block_rows:
                yield done()
                held, n = [], 0
        if n:
            yield done()

    return work


# --- fitting --------------------------------------------------------------------------------


def grow(
    rows: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    forest: Estimator,
    encoder: CategoryModel,
    n: int,
    keys: Sequence[str] = (),
) -> Model:
    """The fitted model of ``forest`` over the ``n`` rows, whose features start with the encoder's slots."""
    spark = rows.sparkSession
    # The workers import this package.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    get, label = forest.getOrDefault, F.col(forest.getLabelCol()).cast("double")
    classes = 0
    if isinstance(forest, RandomForestClassifier):
        top = rows.agg(F.max(label)).first()[0]
        if top is None or not 0 <= top < 100:
            raise ValueError("classes are whole numbers from 0")
        classes = max(2, int(top) + 1)
    features, index = [], 0
    for c in categorical:
        features.append(Feature(index, encoder.sizes[c] + 1, None))
        index += encoder.sizes[c]
    for cuts in thresholds(rows, numeric, get("maxBins")):
        features.append(Feature(index, len(cuts) + 1, cuts))
        index += 1
    placed, cell_bins = _packed(features)
    trees = get("numTrees")
    subset = get("featureSubsetStrategy")
    tried = {"all": index, "sqrt": math.ceil(math.sqrt(index))}[subset]
    exact = not get("bootstrap") and trees == 1
    recipe = Recipe(
        placed, cell_bins, classes, get("maxDepth"), get("seed"), get("bootstrap"), exact, tried,
        BLOCK_ROWS, SUMS_OF_TASK, SUMS_AT_ONCE, CELL_BINS,
    )
    binned = _staged_bins(rows, categorical, numeric, label, encoder, keys, recipe)
    path = staged_path(spark, "grown-forest")
    at_once = spark.sparkContext.defaultParallelism
    tasks = min(trees, TASKS_FOR_ONE * at_once)
    if n <= KEEP_ROWS:
        nodes = _to_all(binned, tasks).mapInArrow(keep_and_grow(recipe, trees, tasks), NODES)
    else:
        levels = _level_by_level(spark, binned, recipe, trees, at_once)
        stored = [(t, pickle.dumps(lv)) for t, lv in enumerate(levels)]
        dealt = spark.createDataFrame(stored, "tree int, levels binary").repartition(tasks, "tree")
        nodes = dealt.mapInArrow(_stored_nodes(recipe), NODES)
    nodes.write.parquet(f"{path}/data")
    return _loaded(spark, forest, path, trees, index, classes)


def _staged_bins(rows, categorical, numeric, label, encoder, keys, recipe) -> DataFrame:
    named = {c: f"_bin_{i}" for i, c in enumerate(categorical)}
    columns = [*categorical, *[F.col(c).cast("double").alias(c) for c in numeric]]
    hashed = F.lit(0).alias("_hash")
    if recipe.bootstrap:
        hashed = F.shiftright(F.xxhash64(*keys, label, *columns), 32).cast("int").alias("_hash")
    kept = rows.select(*dict.fromkeys(categorical), *[c for c in numeric], label.alias("_y"), hashed)
    indexed = encoder.indexed(kept, named).select(
        *named.values(), *[F.col(c).cast("double").alias(c) for c in numeric], "_y", "_hash"
    )
    types = ["short" if b <= 2**15 else "int" for b in recipe.cell_bins]
    schema = ", ".join([*[f"c{i} {t}" for i, t in enumerate(types)], "y double", "h int"])
    path = staged_path(rows.sparkSession, "binned-rows")
    indexed.mapInArrow(_binning(recipe), schema).write.parquet(path)
    # In a session of its own, as a union of single partitions would be one partition else.
    apart = rows.sparkSession.newSession()
    apart.conf.set("spark.sql.unionOutputPartitioning", "false")
    return apart.read.schema(schema).parquet(path)


def _to_all(binned: DataFrame, tasks: int) -> DataFrame:
    """All rows for each of the tasks, with the task's number."""
    whole = binned.coalesce(1)
    copies = [whole.withColumn("_group", F.lit(i)) for i in range(tasks)]
    result = copies[0]
    for copy in copies[1:]:
        result = result.union(copy)
    return result


def _level_by_level(
    spark: SparkSession, binned: DataFrame, recipe: Recipe, trees: int, at_once: int
) -> list[list[Level]]:
    """All levels of all trees, with the sums of few trees in a task.

    Small trees that are fewer than the tasks at once leave the rows where they are: each task
    adds up its own, and the sums of a level meet in the driver.
    """
    grown_trees: list[list[Level]] = [[] for _ in range(trees)]
    open_trees = set(range(trees))
    numbers = trees * 2 ** (recipe.depth - 1) * recipe.stats * sum(recipe.cell_bins)
    in_part = trees < at_once and numbers <= recipe.compared
    tasks = min(trees, max(at_once, math.ceil(numbers / recipe.sums)))
    if in_part:
        rows, tasks = binned.withColumn("_group", F.lit(0)), 1
    else:
        rows = _to_all(binned, tasks)
    while open_trees:
        so_far = [lv if t in open_trees else None for t, lv in enumerate(grown_trees)]
        depth, most = max(len(grown_trees[t]) for t in open_trees), max(_below(grown_trees[t]) for t in open_trees)
        found: dict[int, list[Level]] = {t: [] for t in open_trees}
        for begin in range(0, most, nodes_at_once(recipe)):
            parts: dict[int, Sums] = {}
            work = add_level(recipe, trees, tasks, so_far, begin, in_part)
            # Staged by all tasks at once; the driver then reads one part after the other.
            path, schema = staged_path(spark, "grown-level"), "tree int, found binary"
            rows.mapInArrow(work, schema).write.parquet(path)
            for row in spark.read.schema(schema).parquet(path).toLocalIterator():
                tree, got = row["tree"], pickle.loads(row["found"])
                if not in_part:
                    found[tree].append(got)
                elif tree in parts:
                    parts[tree].join(got)
                else:
                    parts[tree] = got
            for tree, sums in parts.items():
                found[tree].append(chosen(recipe, tree, depth, sums, begin))
            delete(spark, path)
        for tree, level in found.items():
            grown_trees[tree].append(Level.joined(level))
        open_trees = {t for t in open_trees if _below(grown_trees[t])}
    return grown_trees


def _stored_nodes(recipe: Recipe):
    def work(batches):
        for batch in batches:
            for tree, levels in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield node_rows(recipe, tree, pickle.loads(levels))

    return work


def _loaded(
    spark: SparkSession, forest: Estimator, path: str, trees: int, width: int, classes: int
) -> Model:
    """The model whose nodes are in ``path``: with the metadata that Spark stores, read by Spark."""
    kind = "Classification" if classes else "Regression"
    model = RandomForestClassificationModel if classes else RandomForestRegressionModel
    forest.write().save(f"{path}-settings")
    settings = json.loads(spark.read.text(f"{path}-settings/metadata").first()[0])
    package = f"org.apache.spark.ml.{kind.lower()}"
    sizes = {"numFeatures": width, "numTrees": trees} | ({"numClasses": classes} if classes else {})
    whole = settings | sizes | {"class": f"{package}.RandomForest{kind}Model"}
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    single = settings | {"class": f"{package}.DecisionTree{kind}Model"}
    # Settings of the forest alone are unknown to a tree.
    for params in ("paramMap", "defaultParamMap"):
        own = {k: v for k, v in settings[params].items() if k not in FOREST_ONLY}
        single = single | {params: own}
    named = [(t, json.dumps(single | {"uid": f"{forest.uid}_{t}"}), 1.0) for t in range(trees)]
    meta = spark.createDataFrame(named, "_1 int, _2 string, _3 double").coalesce(1)
    meta.write.parquet(f"{path}/treesMetadata")
    return model.load(path)


FOREST_ONLY = ("numTrees", "subsamplingRate", "featureSubsetStrategy", "bootstrap")
