"""Row-level measures of the shipment table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.expr import flag, month_of


def clean_logistics(logistics: DataFrame) -> DataFrame:
    """Source columns plus delay reason without gaps, two flags and three time parts."""
    return logistics.withColumns(
        {
            "logistics_delay_reason": F.coalesce("logistics_delay_reason", F.lit("None")),
            "on_time_flag": flag(F.col("logistics_delay") == 0),
            "delivered_flag": flag(F.col("shipment_status") == "Delivered"),
            "date": F.to_date("ts"),
            "month": month_of("ts"),
            "hour": F.hour("ts"),
        }
    )
