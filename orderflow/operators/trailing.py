"""Trailing means over a daily series, also when one series is very long.

A plain window puts each series into one task. That is right for a daily panel,
where a series has one row per day, but not when a single series holds a large
part of the table. The rows of long series are therefore range-partitioned by
series and order into cells of bounded size; each cell also receives the few rows
that precede it, so every frame sees exactly the rows it would see in the uncut
series. The order may be of any type; only rows that agree in all of it share a cell
for certain.

A row without a series key belongs to no series: its means are missing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from orderflow.session import stage

TRAILING_ROWS = 7
#: Most rows of one series that a single task should sort.
LONG_SERIES_ROWS = 2_000_000
#: Rows that a task of windows gets on average, so that its share does not grow with the input.
WINDOW_ROWS = 250_000


def _means(value: str, window: WindowSpec) -> dict[str, Column]:
    """Mean of the last 7 rows with and without the current one; gaps are skipped.

    Both frames share partitioning and order, so they cost one sort.
    """
    return {
        "avg_daily_sales_7d": F.avg(value).over(window.rowsBetween(1 - TRAILING_ROWS, 0)),
        "ma7_previous": F.avg(value).over(window.rowsBetween(-TRAILING_ROWS, -1)),
    }


def _has_key(series: Sequence[str]) -> Column:
    return reduce(Column.__and__, (F.col(c).isNotNull() for c in series))


def _plain_means(
    df: DataFrame, series: Sequence[str], order: Sequence[str], value: str, rows: int = 0
) -> DataFrame:
    """One window per series. Rows without a key are scattered and get no means.

    If there are more ``rows`` than the session's shuffle partitions should take, the series
    are dealt to more tasks.
    """
    apart = F.when(~_has_key(series), F.xxhash64(*order, value))
    window = Window.partitionBy(*series, "_apart").orderBy(*order)
    means = {n: F.when(_has_key(series), m) for n, m in _means(value, window).items()}
    dealt = df.withColumn("_apart", apart)
    tasks = math.ceil(rows / WINDOW_ROWS)
    if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        dealt = dealt.repartition(tasks, *series, "_apart")
    return dealt.withColumns(means).drop("_apart")


def _long_series(df: DataFrame, series: Sequence[str], long_rows: int) -> DataFrame:
    """Keys and sizes of the long series; at most (all rows / long_rows) of them."""
    counts = df.where(_has_key(series)).groupBy(*series).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > long_rows)


def _cells(
    rows: DataFrame, n: int, series: Sequence[str], order: Sequence[str], long_rows: int
) -> DataFrame:
    """The ``n`` rows of long series with ``cell``, staged; cells sort like the rows.

    Ranges are cut by sampled row counts, on average at half of ``long_rows``, which
    leaves room for the sampling error.
    """
    parts = max(1, -(-2 * n // long_rows))
    ranged = rows.repartitionByRange(parts, *series, *order)
    return stage(ranged.withColumn("cell", F.spark_partition_id()), "cells")


def _lead_in_rows(
    cells: DataFrame, series: Sequence[str], order: Sequence[str], value: str
) -> DataFrame:
    """For every cell of a series, copies of the rows just before it.

    Only the last 7 rows of each cell travel. As no cell is empty, the seven cells
    before one hold all the rows its frames can reach.
    """
    cell = [*series, "cell"]
    latest_first = Window.partitionBy(*cell).orderBy(*[F.desc(c) for c in order])
    tails = (
        cells.select(*cell, *order, value)
        .withColumn("from_end", F.row_number().over(latest_first))
        .where(F.col("from_end") <= TRAILING_ROWS)
        .groupBy(*cell)
        .agg(F.collect_list(F.struct(*order, value)).alias("tail"))
    )
    earlier = Window.partitionBy(*series).orderBy("cell").rowsBetween(-TRAILING_ROWS, -1)
    return (
        tails.withColumn("lead_in", F.flatten(F.collect_list("tail").over(earlier)))
        .select(*cell, F.explode("lead_in").alias("row"))
        .select(*cell, "row.*", F.lit(True).alias("is_lead_in"))
    )


def with_trailing_means(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    value: str,
    *,
    long_rows: int = LONG_SERIES_ROWS,
    rows_at_most: int | None = None,
) -> DataFrame:
    """Add ``avg_daily_sales_7d`` and ``ma7_previous``, frames of 7 rows per series.

    ``order`` starts with the day and continues with tie-breakers. The search
    for long series counts rows by series key; it is skipped where
    ``rows_at_most`` shows that none can exist. Where it finds some, their rows and
    the others are computed apart.
    """
    if rows_at_most is not None and rows_at_most <= long_rows:
        return _plain_means(df, series, order, value)
    found = stage(_long_series(df, series, long_rows), "long-series")
    n = found.agg(F.sum("n")).first()[0]
    rows = df.count() if rows_at_most is None else rows_at_most
    if not n:
        return _plain_means(df, series, order, value, rows)
    long = found.select(*series)
    cells = _cells(df.join(long, list(series), "left_semi"), n, series, order, long_rows)
    lead_in = _lead_in_rows(cells, series, order, value)
    within = Window.partitionBy(*series, "cell").orderBy(*order)
    cut = (
        cells.withColumn("is_lead_in", F.lit(False))
        .unionByName(lead_in, allowMissingColumns=True)
        .withColumns(_means(value, within))
        .where(~F.col("is_lead_in"))
        .drop("cell", "is_lead_in")
    )
    rest = _plain_means(df.join(long, list(series), "left_anti"), series, order, value, rows)
    return cut.select(*rest.columns).unionByName(rest)
