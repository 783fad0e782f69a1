"""Column names and types of the source tables and headings of the exports."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Source headings of the two input files and their column types.
RETAIL_COLUMNS: dict[str, T.DataType] = {
    "Date": T.DateType(),
    "Store ID": T.StringType(),
    "Product ID": T.StringType(),
    "Category": T.StringType(),
    "Region": T.StringType(),
    "Inventory Level": T.DoubleType(),
    "Units Sold": T.DoubleType(),
    "Units Ordered": T.DoubleType(),
    "Demand Forecast": T.DoubleType(),
    "Price": T.DoubleType(),
    "Discount": T.DoubleType(),
    "Weather Condition": T.StringType(),
    "Holiday/Promotion": T.IntegerType(),
    "Competitor Pricing": T.DoubleType(),
    "Seasonality": T.StringType(),
}
LOGISTICS_COLUMNS: dict[str, T.DataType] = {
    "Timestamp": T.TimestampNTZType(),
    "Asset_ID": T.StringType(),
    "Shipment_Status": T.StringType(),
    "Traffic_Status": T.StringType(),
    "Waiting_Time": T.DoubleType(),
    "Asset_Utilization": T.DoubleType(),
    "Logistics_Delay": T.IntegerType(),
    "Logistics_Delay_Reason": T.StringType(),
    "Temperature": T.DoubleType(),
    "Humidity": T.DoubleType(),
    "User_Transaction_Amount": T.DoubleType(),
    "User_Purchase_Frequency": T.DoubleType(),
    "Inventory_Level": T.DoubleType(),
}

# Texts that the input files use for a missing value.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Columns of the report's shipment list.
DETAIL_COLUMNS = (
    "ts",
    "asset_id",
    "shipment_status",
    "traffic_status",
    "waiting_time",
    "logistics_delay",
    "logistics_delay_reason",
    "delay_risk_score",
)

# Export headings that title-casing the column name does not give.
SPECIAL_HEADINGS = {
    "store_id": "Store ID",
    "product_id": "Product ID",
    "asset_id": "Asset_ID",
    "ts": "Timestamp",
    "forecast_ape": "Forecast_APE",
    "forecast_mape": "Forecast_MAPE",
    "forecast_wape_pct": "Forecast_WAPE_Pct",
    "avg_days_of_supply": "Avg_Days_of_Supply",
    "share_of_delays_pct": "Share_of_Delays_Pct",
    "naive_moving_avg_baseline": "Naive_MovingAvg_Baseline",
    "random_forest_model": "RandomForest_Model",
}


def column_name(heading: str) -> str:
    """``'Holiday/Promotion '`` to ``'holiday_promotion'``; the timestamp becomes ``ts``."""
    name = re.sub(r"[^0-9a-z]+", "_", heading.strip().lower()).strip("_")
    return "ts" if name == "timestamp" else name


def heading(name: str) -> str:
    """Heading of a column in the exported CSV tables."""
    return SPECIAL_HEADINGS.get(name, name.title())


def struct(columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(column_name(h), t) for h, t in columns.items()])


RETAIL = struct(RETAIL_COLUMNS)
LOGISTICS = struct(LOGISTICS_COLUMNS)
