"""Row-level measures of the store x product x day table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.expr import flag, month_of
from orderflow.operators.trailing import LONG_SERIES_ROWS, with_trailing_means

SERIES = ("store_id", "product_id")
OVERSTOCK_DAYS = 30


def with_row_measures(retail: DataFrame) -> DataFrame:
    """Measures that need only the row itself."""
    units, forecast = F.col("units_sold"), F.col("demand_forecast")
    stock, price = F.col("inventory_level"), F.col("price")
    return (
        retail.withColumns(
            {
                "revenue": units * price * (1 - F.col("discount") / 100),
                "forecast_error": forecast - units,
                "forecast_abs_error": F.abs(forecast - units),
                "stockout_occurred": flag(units >= stock),
                "stockout_risk": flag(forecast > stock),
                "price_gap_vs_competitor": price - F.col("competitor_pricing"),
                "year": F.year("date"),
                "month": month_of("date"),
                "day_of_week": F.date_format("date", "EEEE"),
            }
        ).withColumns(
            {
                "forecast_ape": F.when(units > 0, F.col("forecast_abs_error") / units),
                "priced_above_competitor": flag(F.col("price_gap_vs_competitor") > 0),
            }
        )
    )


def with_series_measures(
    retail: DataFrame,
    tie_breakers: Sequence[str] = (),
    *,
    long_rows: int = LONG_SERIES_ROWS,
    rows_at_most: int | None = None,
) -> DataFrame:
    """Measures that look back along the store-product series.

    Category and region change inside a series, so they are not part of its key.
    """
    trailing = with_trailing_means(
        retail,
        SERIES,
        ("date", *tie_breakers),
        "units_sold",
        long_rows=long_rows,
        rows_at_most=rows_at_most,
    )
    speed = F.col("avg_daily_sales_7d")
    overall_mean = retail.agg(F.avg("units_sold")).scalar()
    return (
        trailing.withColumn(
            "days_of_supply", F.when(speed > 0, F.col("inventory_level") / speed)
        )
        .withColumn("overstock_flag", flag(F.col("days_of_supply") > OVERSTOCK_DAYS))
        .withColumn("naive_ma7_forecast", F.coalesce("ma7_previous", overall_mean))
        .drop("ma7_previous")
    )


def clean_retail(
    retail: DataFrame,
    tie_breakers: Sequence[str] = (),
    *,
    long_rows: int = LONG_SERIES_ROWS,
    rows_at_most: int | None = None,
) -> DataFrame:
    """Source columns plus the 15 derived ones.

    Measures of the row come last, so that the shuffles and staged cells of long series do
    not carry them.
    """
    series = with_series_measures(
        retail, tie_breakers, long_rows=long_rows, rows_at_most=rows_at_most
    )
    added = [c for c in series.columns if c not in retail.columns]
    whole = with_row_measures(series)
    return whole.select(*[c for c in whole.columns if c not in added], *added)


def sorted_panel(retail: DataFrame, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Rows in store, product, day order, for exports; windows sort on their own."""
    return retail.orderBy(*SERIES, "date", *tie_breakers)
