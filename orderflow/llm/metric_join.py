"""Embedding near-dedup: exact metric range join inside each label.

Vectors link if their cosine is at least ``COSINE``, which for unit vectors is a distance
of at most r = sqrt(2 - 2 * COSINE). Equal vectors of a label are one node. The nodes of a
label are dealt to cells by their nearest pivot; pivots are nodes drawn by hash, about
``sqrt(n) / FINE`` of n nodes. A node is at home in one cell and a guest in each cell that
may hold a partner at home there. By the triangle inequality a cell with pivot p and
radius R can hold none of y if d(y, p) > R + r, nor if d(y, p) > d(y, q) + 2 r for another
pivot q (a home node is nearer to p than to q), nor, in Euclidean
space, if y lies more than r on the other side of the plane between p and y's own pivot.

Cells join independently: every partner of a node at home is in its cell, so its links are
counted there and only there. Cells are compared in blocks of nodes
at home against blocks of all nodes in it, so that a dense cell is split. A block returns counts and a
spanning forest of its links (each linked node with the block's root), never the pairs;
components of these are those of all links.

Pivots meet the nodes of their label in chunks, by cogroup. Vectors without structure
are guests nearly everywhere (the nearest of random pivots is hardly nearer than others);
then the cells are the blocks of a nested loop, and the result stays exact.

Defined cases: null labels, null, empty and zero vectors and such with null or non-finite
components link with nothing, vectors of different length neither; equal vectors always
link; rows that repeat a vec_id are vectors of their own; a component's id is its smallest
vec_id that is not null; rows without vec_id are never kept; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.llm.common import apart, attach
from orderflow.llm.components import components
from orderflow.session import stage

COSINE = 0.93
#: A label of n nodes has sqrt(n) / FINE pivots.
FINE = 16
#: Components of vectors that meet their label's pivots in one group.
CHUNK = 1 << 19
#: Components of vectors at home, and of those they are compared with, in one block.
HOME, GUEST = 1 << 18, 1 << 20
#: Rows of a block that are compared at once.
ROWS = 256
#: Slack for rounding in distances; too many guests do no harm.
SLACK = 1e-6
SPACE = ["label", "dims"]
CELL = [*SPACE, "cell"]


def _vectors(column: pa.Array) -> Iterator[np.ndarray | None]:
    """Unit vectors; None for those that cannot link."""
    for value in column.to_pylist():
        if value is None or None in value:
            yield None
            continue
        vector = np.array(value, np.float64)
        with np.errstate(over="ignore", invalid="ignore"):
            size = np.abs(vector).max(initial=0.0)
            vector = vector / size if size > 0 and np.isfinite(size) else vector * 0
            norm = np.sqrt(vector @ vector)
        yield vector / norm + 0.0 if np.isfinite(norm) and norm > 0 else None


def read_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, label, node, dims, unit of each row; node is null if it links with nothing; staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label").to_pylist()
            raws = batch.column("embedding").to_pylist()
            nodes, dims, units = [], [], []
            for label, raw, unit in zip(labels, raws, _vectors(batch.column("embedding"))):
                if unit is None or label is None:
                    nodes.append(None), dims.append(None), units.append(None)
                    continue
                held = (np.array(raw, np.float64) + 0.0).tobytes()
                nodes.append(hashlib.blake2b(label.encode() + b"\0" + held, digest_size=16).digest())
                dims.append(len(unit))
                units.append(unit.tobytes())
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), pa.array(labels, pa.string()), pa.array(nodes, pa.binary()),
                pa.array(dims, pa.int32()), pa.array(units, pa.binary()),
            ], ["vec_id", "label", "node", "dims", "unit"])

    asked = rows.select(F.col("vec_id").cast("long").alias("vec_id"),
                        F.col("label").cast("string").alias("label"), "embedding")
    return stage(
        asked.mapInArrow(run, "vec_id long, label string, node binary, dims int, unit binary"), "vectors")


def _matrix(table: pa.Table | pa.RecordBatch, column: str = "unit") -> np.ndarray:
    """The vectors of a group as rows."""
    values = table.column(column)
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    data = b"".join(values.to_pylist())
    return np.frombuffer(data, np.float64).reshape(len(values), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def reach(cosine: float) -> float:
    return float(np.sqrt(2.0 - 2.0 * cosine))


def _deal(cosine: float):
    """A chunk of nodes and its label's pivots: the home cell and the cells that may hold partners."""
    r = reach(cosine)

    def run(nodes: pa.Table, pivots: pa.Table) -> pa.Table:
        units = _matrix(nodes)
        if pivots.num_rows:
            order = np.argsort(pivots.column("cell").to_numpy())
            centres = _matrix(pivots)[order]
            away = _distances(units, centres)
            apart = _distances(centres, centres)
            home = away.argmin(1)
            near = away[np.arange(len(units)), home]
            may = away <= near[:, None] + 2 * r + SLACK
            across = apart[home]
            gap = (away**2 - near[:, None] ** 2) / np.maximum(2 * across, SLACK)
            may &= (gap <= r + SLACK) | (across < SLACK)
            may[np.arange(len(units)), home] = True
        else:
            home, may, away = np.zeros(len(units), int), np.ones((len(units), 1), bool), np.zeros((len(units), 1))
        rows, cells = np.nonzero(may)
        ends = np.cumsum(may.sum(1))
        offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
        return pa.table({
            **{c: nodes.column(c) for c in ("node", *SPACE, "copies", "unit")},
            "home": pa.array(home, pa.int32()),
            "cells": pa.ListArray.from_arrays(offsets, pa.array(cells, pa.int32())),
            "aways": pa.ListArray.from_arrays(offsets, pa.array(away[rows, cells], pa.float64())),
        })

    return run


def _roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index of the component of each of ``n`` nodes."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            x, y = root[a], root[b]
            if not (open_ := x != y).any():
                break
            a, b = a[open_], b[open_]
            low = np.minimum(x[open_], y[open_])
            np.minimum.at(root, x[open_], low)
            np.minimum.at(root, y[open_], low)
            while not (root == (up := root[root])).all():
                root = up
    return root


def _compare(cosine: float):
    """A block: links of its home nodes with the others, as counts and a spanning forest."""

    def run(rows: pa.Table) -> pa.Table:
        at_home = rows.column("at_home").to_numpy()
        units, copies = _matrix(rows), rows.column("copies").to_numpy()
        names = rows.column("node").to_pylist()
        # a node that is in the block at home and as another is one node of the forest
        number: dict[bytes, int] = {}
        node = np.array([number.setdefault(x, len(number)) for x in names])
        home, other = np.flatnonzero(at_home), np.flatnonzero(~at_home)
        links = np.zeros(len(number), np.int64)

        def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for begin in range(0, len(home), ROWS):
                own = home[begin:begin + ROWS]
                near = units[own] @ units[other].T >= cosine
                near &= node[own][:, None] != node[other][None, :]
                links[node[own]] += near @ copies[other]
                a, b = np.nonzero(near)
                yield node[own][a], node[other][b]

        root = _roots(len(number), pairs())
        keep = np.flatnonzero((links > 0) | (root != np.arange(len(number))))
        every = np.array(list(number), object)
        return pa.table({
            "node": pa.array(every[keep].tolist(), pa.binary()),
            "links": pa.array(links[keep], pa.int64()),
            "root": pa.array(every[root[keep]].tolist(), pa.binary()),
        })

    return run


def _parts(n: str, size: int) -> Column:
    """Blocks for ``n`` vectors, each of about ``size`` components."""
    return F.ceil(F.col(n) * F.col("dims") / size).cast("int")


def _part(n: str, size: int) -> Column:
    """The block of a node among ``n`` nodes."""
    return F.pmod(F.xxhash64("node"), _parts(n, size)).cast("int")


def dealt(nodes: DataFrame, cosine: float = COSINE, fine: float = FINE, chunk: int = CHUNK) -> DataFrame:
    """Nodes with home, cells that may hold partners and distances to their pivots; staged."""
    sizes = nodes.groupBy(*SPACE).agg(F.count(F.lit(1)).alias("n")).select(
        *SPACE, "n", F.ceil(F.sqrt("n") / fine).cast("int").alias("pivots"),
        _parts("n", chunk).alias("chunks"))
    sizes = stage(sizes, "labels")
    known = attach(nodes, sizes, SPACE, "inner")
    # a few times as many as needed, so that a label's window is short
    draw = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)
    first = Window.partitionBy(*SPACE).orderBy("draw", "node")
    pivots = (
        known.where("pivots > 1").withColumn("draw", draw)
        .where(F.col("draw") * F.col("n") < F.col("pivots") * 4 + 16)
        .withColumn("cell", F.row_number().over(first) - 1).where("cell < pivots")
        .select(*SPACE, "cell", "unit", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    )
    chunked = known.select("node", *SPACE, "copies", "unit",
                           F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"))
    group = [*SPACE, "chunk"]
    return stage(
        chunked.groupBy(*group).cogroup(apart(pivots).groupBy(*group)).applyInArrow(
            _deal(cosine), "node binary, label string, dims int, copies long, unit binary, home int, "
                           "cells array<int>, aways array<double>"),
        "dealt")


def members(at: DataFrame, cosine: float = COSINE) -> DataFrame:
    """A row for each node in each cell where it is at home or may have partners."""
    radius = at.select(*SPACE, F.col("home").alias("cell"), F.element_at(
        "aways", F.array_position("cells", F.col("home")).cast("int")).alias("away"))
    radius = stage(radius.groupBy(*CELL).agg(
        F.max("away").alias("radius"), F.count(F.lit(1)).alias("homes")), "cells")
    every = at.select("node", *SPACE, "copies", "unit", "home",
                      F.explode(F.arrays_zip("cells", "aways")).alias("one"))
    every = every.select("*", F.col("one.cells").alias("cell"), F.col("one.aways").alias("away")).drop("one")
    return attach(every, radius, CELL, "inner").where(
        (F.col("cell") == F.col("home"))
        | (F.col("away") <= F.col("radius") + reach(cosine) + SLACK))


def links(nodes: DataFrame, cosine: float = COSINE, fine: float = FINE, chunk: int = CHUNK,
          home: int = HOME, guest: int = GUEST) -> DataFrame:
    """node, links (partners with their copies), root: counts and forests of all blocks; staged."""
    inside = members(dealt(nodes, cosine, fine, chunk), cosine)
    sizes = stage(inside.groupBy(*CELL).agg(F.count(F.lit(1)).alias("all")), "cell-sizes")
    inside = attach(inside, sizes, CELL, "inner")
    rows, columns = _parts("homes", home), _parts("all", guest)
    own = inside.where("cell = home").select(
        *CELL, _part("homes", home).alias("row"),
        F.explode(F.sequence(F.lit(0), columns - 1)).alias("column"),
        "node", "copies", "unit", F.lit(True).alias("at_home"))
    others = inside.select(
        *CELL, F.explode(F.sequence(F.lit(0), rows - 1)).alias("row"),
        _part("all", guest).alias("column"),
        "node", "copies", "unit", F.lit(False).alias("at_home"))
    blocks = own.unionByName(others).groupBy(*CELL, "row", "column")
    return stage(blocks.applyInArrow(_compare(cosine), "node binary, links long, root binary"), "links")


def near_duplicates(rows: DataFrame, cosine: float = COSINE, fine: float = FINE, chunk: int = CHUNK,
                    home: int = HOME, guest: int = GUEST) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for each vector."""
    vectors = read_vectors(rows)
    nodes = stage(
        vectors.where("node IS NOT NULL").groupBy("node").agg(
            F.first("label").alias("label"), F.first("dims").alias("dims"), F.first("unit").alias("unit"),
            F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least")),
        "nodes")
    found = links(nodes, cosine, fine, chunk, home, guest)
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    forest = components(found.where("node <> root").select(
        F.least("node", "root").alias("a"), F.greatest("node", "root").alias("b")))
    rooted = nodes.select("node", "copies", "least").join(
        forest.select(F.col("b").alias("node"), F.col("a").alias("root")), "node", "left"
    ).join(counts, "node", "left").select(
        "node", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("root", "node").alias("root"))
    rooted = stage(rooted, "rooted")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = stage(rooted.join(ids, "root").select("node", "n_links", "component_id"), "node-links")
    return attach(vectors.select("vec_id", "node"), known, ["node"]).select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).select("*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
