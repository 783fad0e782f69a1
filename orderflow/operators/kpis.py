"""KPI tables. Rows with a missing group key are left out; means skip missing values.

Every table can be built from the row-level table or from its *totals*: sums and
counts by all group keys at once. A batch run stages the totals and then builds
all tables from them, which reads the row-level table once instead of once per
table. A single table is built from the rows directly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.expr import percent, total, with_keys

RETAIL_KEYS = ("date", "month", "region", "category", "holiday_promotion")
RETAIL_MEASURES = (
    "units_sold",
    "units_ordered",
    "revenue",
    "forecast_abs_error",
    "forecast_ape",
    "inventory_level",
    "stockout_occurred",
    "overstock_flag",
    "days_of_supply",
)
LOGISTICS_KEYS = (
    "asset_id",
    "traffic_status",
    "month",
    "logistics_delay",
    "logistics_delay_reason",
)
LOGISTICS_MEASURES = ("on_time_flag", "delivered_flag", "waiting_time", "asset_utilization")

ROWS = "rows"


def _count_of(column: str) -> str:
    return f"{column}_count"


def _totals(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in measures]
    counts = [F.count(c).alias(_count_of(c)) for c in measures]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS), *sums, *counts)


def retail_totals(retail: DataFrame) -> DataFrame:
    return _totals(retail, RETAIL_KEYS, RETAIL_MEASURES)


def logistics_totals(logistics: DataFrame) -> DataFrame:
    return _totals(logistics, LOGISTICS_KEYS, LOGISTICS_MEASURES)


def _row_count(df: DataFrame) -> Column:
    return F.sum(ROWS) if ROWS in df.columns else F.count(F.lit(1))


def _mean(df: DataFrame, column: str) -> Column:
    """Mean of the rows behind ``df``, which holds rows or totals."""
    if _count_of(column) in df.columns:
        return F.try_divide(F.sum(column), F.sum(_count_of(column)))
    return F.avg(column)


def _share_with(df: DataFrame, key: str) -> Column:
    """Mean of a 0/1 key column over the rows behind ``df``."""
    if ROWS in df.columns:
        known = F.when(F.col(key).isNotNull(), F.col(ROWS))
        return F.try_divide(F.sum(F.col(key) * F.col(ROWS)), F.sum(known))
    return F.avg(key)


def _grouped(df: DataFrame, *keys: str):
    return with_keys(df, *keys).groupBy(*keys)


# --- retail ---------------------------------------------------------------------------


def retail_kpi_daily(retail: DataFrame) -> DataFrame:
    return _grouped(retail, "date", "region", "category").agg(
        total("units_sold").alias("units_sold"),
        total("units_ordered").alias("units_ordered"),
        total("revenue").alias("revenue"),
        _mean(retail, "inventory_level").alias("avg_inventory"),
        _mean(retail, "forecast_ape").alias("forecast_ape"),
        _mean(retail, "stockout_occurred").alias("stockout_rate"),
        _mean(retail, "overstock_flag").alias("overstock_rate"),
        _mean(retail, "days_of_supply").alias("avg_days_of_supply"),
        _share_with(retail, "holiday_promotion").alias("promo_share"),
    )


def retail_kpi_monthly(retail: DataFrame) -> DataFrame:
    return _grouped(retail, "month", "region", "category").agg(
        total("units_sold").alias("units_sold"),
        total("revenue").alias("revenue"),
        _mean(retail, "forecast_ape").alias("forecast_mape"),
        _mean(retail, "stockout_occurred").alias("stockout_rate"),
        _mean(retail, "days_of_supply").alias("avg_days_of_supply"),
    )


def retail_monthly_overall(retail: DataFrame) -> DataFrame:
    error_share = F.try_divide(total("forecast_abs_error"), total("units_sold"))
    return _grouped(retail, "month").agg(
        total("revenue").alias("revenue"),
        total("units_sold").alias("units_sold"),
        percent(error_share).alias("forecast_wape_pct"),
        percent(_mean(retail, "stockout_occurred")).alias("stockout_rate_pct"),
        _mean(retail, "days_of_supply").alias("avg_days_of_supply"),
    )


def retail_category_summary(retail: DataFrame) -> DataFrame:
    return (
        _grouped(retail, "category")
        .agg(
            total("revenue").alias("total_revenue"),
            total("units_sold").alias("total_units_sold"),
            _mean(retail, "forecast_ape").alias("forecast_mape"),
            _mean(retail, "stockout_occurred").alias("stockout_rate"),
            _mean(retail, "overstock_flag").alias("overstock_rate"),
            _mean(retail, "days_of_supply").alias("avg_days_of_supply"),
        )
        .orderBy(F.desc_nulls_last("total_revenue"), "category")
    )


def units_by_promo(retail: DataFrame) -> DataFrame:
    """Mean units per category, without and with promotion side by side."""
    wide = (
        _grouped(with_keys(retail, "holiday_promotion"), "category")
        .pivot("holiday_promotion", [0, 1])
        .agg(_mean(retail, "units_sold"))
    )
    return wide.withColumnsRenamed({"0": "avg_units_no_promo", "1": "avg_units_with_promo"})


def retail_promo_lift(retail: DataFrame) -> DataFrame:
    without, with_promo = F.col("avg_units_no_promo"), F.col("avg_units_with_promo")
    lift = F.try_divide(with_promo - without, without)
    return units_by_promo(retail).withColumn("promo_lift_pct", percent(lift))


# --- logistics ------------------------------------------------------------------------


def logistics_asset_kpi(logistics: DataFrame) -> DataFrame:
    return (
        _grouped(logistics, "asset_id")
        .agg(
            _row_count(logistics).alias("shipments"),
            _mean(logistics, "on_time_flag").alias("on_time_rate"),
            _mean(logistics, "waiting_time").alias("avg_waiting_time"),
            _mean(logistics, "asset_utilization").alias("avg_asset_utilization"),
            _mean(logistics, "delivered_flag").alias("delivered_rate"),
        )
        .orderBy(F.asc_nulls_last("on_time_rate"), "asset_id")
    )


def _punctuality(logistics: DataFrame, key: str) -> DataFrame:
    return _grouped(logistics, key).agg(
        _row_count(logistics).alias("shipments"),
        _mean(logistics, "on_time_flag").alias("on_time_rate"),
        _mean(logistics, "waiting_time").alias("avg_waiting_time"),
    )


def logistics_traffic_kpi(logistics: DataFrame) -> DataFrame:
    return _punctuality(logistics, "traffic_status")


def logistics_monthly_otd(logistics: DataFrame) -> DataFrame:
    return _punctuality(logistics, "month")


def delay_reason_share(logistics: DataFrame, name: str = "share_pct") -> DataFrame:
    """Share of each reason among the delayed shipments, in percent, largest first."""
    delayed = logistics.where(F.col("logistics_delay") == 1)
    counts = (
        _grouped(delayed, "logistics_delay_reason")
        .agg(_row_count(logistics).alias("n"))
        .withColumnRenamed("logistics_delay_reason", "delay_reason")
    )
    all_delays = counts.agg(F.sum("n")).scalar()
    return (
        counts.withColumn(name, percent(F.col("n") / all_delays))
        .orderBy(F.desc("n"), "delay_reason")
        .drop("n")
    )


def logistics_delay_reason_kpi(logistics: DataFrame) -> DataFrame:
    """As :func:`delay_reason_share`, to one decimal with ties to the even digit."""
    share = "share_of_delays_pct"
    return delay_reason_share(logistics, share).withColumn(share, F.bround(share, 1))
