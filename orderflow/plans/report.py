"""Filtered report queries over the cleaned and aggregated tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.functions.expr import flag, key_hash, percent, total, with_keys
from orderflow.operators.kpis import delay_reason_share
from orderflow.operators.bridge import SEED
from orderflow.session import stage
from orderflow.sources import tables
from orderflow.sources.schemas import DETAIL_COLUMNS

DETAIL_ROWS = 200
#: Choices of more values than this are joined instead of listed in the plan.
LISTED_VALUES = 200


def one_of(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose ``column`` is one of ``values``; a long list is a semi join."""
    if len(values) <= LISTED_VALUES:
        return df.where(F.col(column).isin(*values))
    chosen = df.sparkSession.createDataFrame([(v,) for v in set(values)], f"`{column}` string")
    return df.join(chosen, column, "left_semi").select(*df.columns)


@dataclass(frozen=True)
class FilterSpec:
    """A reader's choices; ``None`` keeps everything.

    Region and dates reach the retail rows only, trucks the shipments only.
    Category also reaches the bridge and the tables aggregated by category.
    """

    regions: Sequence[str] | None = None
    categories: Sequence[str] | None = None
    start: dt.date | None = None
    end: dt.date | None = None
    trucks: Sequence[str] | None = None

    def retail(self, df: DataFrame) -> DataFrame:
        rules: list[Column] = []
        if self.regions is not None:
            df = one_of(df, "region", self.regions)
        if self.categories is not None:
            df = one_of(df, "category", self.categories)
        # The month limits follow from the dates; they prune month partitions.
        if self.start is not None:
            rules.append(F.col("date") >= F.lit(self.start))
            if "month" in df.columns:
                rules.append(F.col("month") >= f"{self.start:%Y-%m}")
        if self.end is not None:
            rules.append(F.col("date") <= F.lit(self.end))
            if "month" in df.columns:
                rules.append(F.col("month") <= f"{self.end:%Y-%m}")
        for rule in rules:
            df = df.where(rule)
        return df

    def by_category(self, df: DataFrame) -> DataFrame:
        """The bridge, or a table already aggregated by category."""
        if self.categories is None:
            return df
        return one_of(df, "category", self.categories)

    def logistics(self, df: DataFrame) -> DataFrame:
        if self.trucks is None:
            return df
        return one_of(df, "asset_id", self.trucks)


# --- choices ----------------------------------------------------------------------------


def choices(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a filter column, sorted."""
    return with_keys(df, column).select(column).distinct().orderBy(column)


def date_span(retail: DataFrame) -> DataFrame:
    return retail.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


#: Small stored tables that have every value of a filter column.
CHOICE_TABLES = {
    "category": "retail_category_summary",
    "region": "retail_kpi_monthly",
    "asset_id": "logistics_asset_kpi",
}


def stored_choices(spark: SparkSession, out_dir: str, column: str) -> DataFrame:
    """As :func:`choices`, from a stored KPI table instead of the rows.

    Regions come from the monthly table, which leaves out rows without category or month.
    """
    return choices(tables.read_table(spark, out_dir, CHOICE_TABLES[column]), column)


def stored_date_span(spark: SparkSession, out_dir: str) -> DataFrame:
    """As :func:`date_span`, from the statistics in the files' footers; reads no column."""
    return date_span(tables.read_footers(spark, out_dir, "retail_cleaned"))


def nothing_selected(retail: DataFrame, logistics: DataFrame) -> bool:
    """True when a filtered table has no row; reads no more than one row of each."""
    return retail.isEmpty() or logistics.isEmpty()


# --- cards ------------------------------------------------------------------------------


def kpi_cards(retail: DataFrame, logistics: DataFrame, bridge: DataFrame) -> DataFrame:
    """Headline figures of the selection in one row; a rate over no rows is NULL."""
    return retail.agg(
        total("revenue").alias("total_revenue"),
        total("units_sold").alias("units_sold"),
        F.avg("stockout_occurred").alias("stockout_rate"),
    ).withColumns(
        {
            "on_time_rate": logistics.agg(F.avg("on_time_flag")).scalar(),
            "perfect_order_rate": bridge.agg(F.avg("perfect_order")).scalar(),
        }
    )


def headline_rates(logistics: DataFrame, bridge: DataFrame) -> DataFrame:
    """On-time rate of all shipments and blended perfect order rate."""
    return logistics.agg(F.avg("on_time_flag").alias("on_time_rate")).withColumn(
        "perfect_order_rate", bridge.agg(F.avg("perfect_order")).scalar()
    )


def rate_components(bridge: DataFrame, *more: Column) -> DataFrame:
    return bridge.agg(
        percent(F.avg(flag(F.col("stockout_occurred") == 0))).alias("stockout_free_pct"),
        percent(F.avg("delivered_on_time")).alias("on_time_pct"),
        *more,
    )


def metric_value(table: DataFrame, metric: str, column: str) -> DataFrame:
    """One figure of a metric table, looked up by its name."""
    return table.where(F.col("metric") == metric).select(column)


# --- panels -----------------------------------------------------------------------------


def _by(df: DataFrame, key: str, measure: Column) -> DataFrame:
    return with_keys(df, key).groupBy(key).agg(measure)


def revenue_by_category(retail: DataFrame) -> DataFrame:
    return _by(retail, "category", total("revenue").alias("revenue")).orderBy(
        F.desc_nulls_last("revenue"), "category"
    )


def monthly_revenue(retail: DataFrame) -> DataFrame:
    return _by(retail, "month", total("revenue").alias("revenue")).orderBy("month")


def stockout_by_category(retail: DataFrame) -> DataFrame:
    return _by(retail, "category", F.avg("stockout_occurred").alias("stockout_rate"))


def on_time_by_traffic(logistics: DataFrame) -> DataFrame:
    return _by(logistics, "traffic_status", F.avg("on_time_flag").alias("on_time_rate"))


def delay_causes(logistics: DataFrame) -> DataFrame:
    return delay_reason_share(logistics)


def truck_table(logistics: DataFrame) -> DataFrame:
    return (
        with_keys(logistics, "asset_id")
        .groupBy("asset_id")
        .agg(
            F.count("asset_id").alias("shipments"),
            F.avg("on_time_flag").alias("on_time_rate"),
            F.avg("waiting_time").alias("avg_waiting_time"),
        )
        .orderBy(F.asc_nulls_last("on_time_rate"), "asset_id")
    )


def monthly_on_time(logistics: DataFrame) -> DataFrame:
    return _by(logistics, "month", F.avg("on_time_flag").alias("on_time_rate")).orderBy("month")


# --- all panels of a selection in one pass ------------------------------------------------

#: Group keys of the panels of each table; a panel is named after its key.
RETAIL_PANELS = ("category", "month")
LOGISTICS_PANELS = ("traffic_status", "logistics_delay_reason", "asset_id", "month")
WHOLE = "whole"


def _panel_rows(df: DataFrame, keys: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """(panel, key, measures): one group for each value of each key, and one of all rows.

    Grouping sets read the rows once and add them up in parts before the shuffle, so what is
    shuffled is as long as the panels.
    """
    grouped = df.groupingSets([[], *[[k] for k in keys]], *keys).agg(
        F.grouping_id().alias("set"), *measures
    )
    every = (1 << len(keys)) - 1
    panel, key = F.when(F.col("set") == every, F.lit(WHOLE)), F.lit(None).cast("string")
    for i, name in enumerate(keys):
        own = F.col("set") == every - (1 << (len(keys) - 1 - i))
        panel, key = panel.when(own, F.lit(name)), F.when(own, F.col(name)).otherwise(key)
    return (
        grouped.withColumns({"panel": panel, "key": key})
        .where((F.col("panel") == WHOLE) | F.col("key").isNotNull())
        .drop("set", *keys)
    )


@dataclass(frozen=True)
class Dashboard:
    """All cards and panels of one selection; each of the three tables is read once.

    The rows of the panels are staged, so a panel only picks its rows from a small table.
    """

    retail: DataFrame
    logistics: DataFrame
    bridge: DataFrame

    @classmethod
    def of(cls, pick: FilterSpec, retail: DataFrame, logistics: DataFrame, bridge: DataFrame):
        delayed = F.count_if(F.col("logistics_delay") == 1).alias("delays")
        return cls(
            stage(
                _panel_rows(
                    pick.retail(retail),
                    RETAIL_PANELS,
                    [
                        total("revenue").alias("revenue"),
                        total("units_sold").alias("units_sold"),
                        F.avg("stockout_occurred").alias("stockout_rate"),
                    ],
                ),
                "retail-panels",
            ),
            stage(
                _panel_rows(
                    pick.logistics(logistics),
                    LOGISTICS_PANELS,
                    [
                        F.count(F.lit(1)).alias("shipments"),
                        F.avg("on_time_flag").alias("on_time_rate"),
                        F.avg("waiting_time").alias("avg_waiting_time"),
                        delayed,
                    ],
                ),
                "logistics-panels",
            ),
            stage(
                rate_components(
                    pick.by_category(bridge), F.avg("perfect_order").alias("perfect_order_rate")
                ),
                "bridge-panels",
            ),
        )

    def _panel(self, table: DataFrame, name: str, *columns: str) -> DataFrame:
        return table.where(F.col("panel") == name).select(F.col("key").alias(name), *columns)

    def cards(self) -> DataFrame:
        retail, logistics = (t.where(F.col("panel") == WHOLE) for t in (self.retail, self.logistics))
        return retail.agg(
            F.coalesce(F.max("revenue"), F.lit(0.0)).alias("total_revenue"),
            F.coalesce(F.max("units_sold"), F.lit(0.0)).alias("units_sold"),
            F.max("stockout_rate").alias("stockout_rate"),
        ).withColumns(
            {
                "on_time_rate": logistics.agg(F.max("on_time_rate")).scalar(),
                "perfect_order_rate": self.bridge.select("perfect_order_rate").scalar(),
            }
        )

    def revenue_by_category(self) -> DataFrame:
        return self._panel(self.retail, "category", "revenue").orderBy(
            F.desc_nulls_last("revenue"), "category"
        )

    def monthly_revenue(self) -> DataFrame:
        return self._panel(self.retail, "month", "revenue").orderBy("month")

    def stockout_by_category(self) -> DataFrame:
        return self._panel(self.retail, "category", "stockout_rate")

    def on_time_by_traffic(self) -> DataFrame:
        return self._panel(self.logistics, "traffic_status", "on_time_rate")

    def delay_causes(self) -> DataFrame:
        causes = self._panel(self.logistics, "logistics_delay_reason", "delays").where("delays > 0")
        all_delays = causes.agg(F.sum("delays")).scalar()
        return (
            causes.orderBy(F.desc("delays"), "logistics_delay_reason")
            .select(
                F.col("logistics_delay_reason").alias("delay_reason"),
                percent(F.col("delays") / all_delays).alias("share_pct"),
            )
        )

    def truck_table(self) -> DataFrame:
        columns = ("shipments", "on_time_rate", "avg_waiting_time")
        return self._panel(self.logistics, "asset_id", *columns).orderBy(
            F.asc_nulls_last("on_time_rate"), "asset_id"
        )

    def monthly_on_time(self) -> DataFrame:
        return self._panel(self.logistics, "month", "on_time_rate").orderBy("month")

    def rate_components(self) -> DataFrame:
        return self.bridge.select("stockout_free_pct", "on_time_pct")


# --- detail -----------------------------------------------------------------------------


def latest_shipments(
    logistics: DataFrame, key: str = "shipment_id", rows: int = DETAIL_ROWS
) -> DataFrame:
    """The newest shipments; each task keeps only its own newest rows."""
    columns = [c for c in DETAIL_COLUMNS if c in logistics.columns]
    return logistics.orderBy(F.desc("ts"), key).limit(rows).select(key, *columns)


def top_features(importance: DataFrame, rows: int = 10) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(rows)


def bridge_sample(bridge: DataFrame, rows: int = DETAIL_ROWS, seed: int = SEED) -> DataFrame:
    """Exactly ``rows`` random events (or all, if fewer), the same ones every time."""
    key = ("month", "store_id", "product_id")
    return (
        bridge.withColumn("_hash", key_hash(seed, F.lit("sample"), *key))
        .orderBy("_hash", *key)
        .limit(rows)
        .drop("_hash")
    )
