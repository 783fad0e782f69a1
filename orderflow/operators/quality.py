"""Two data checks that the analysis rests on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.operators.retail import SERIES


def forecast_leakage(retail: DataFrame) -> DataFrame:
    """Correlation of the supplied forecast with the sales it claims to predict."""
    return retail.agg(F.corr("demand_forecast", "units_sold").alias("correlation"))


def attribute_stability(retail: DataFrame) -> DataFrame:
    """How many categories and regions occur inside each store-product series.

    Repeated pairs are removed first, so that the two distinct counts work on
    pairs instead of doubling every row.
    """
    pairs = retail.select(*SERIES, "category", "region").distinct()
    return pairs.groupBy(*SERIES).agg(
        F.count_distinct("category").alias("categories"),
        F.count_distinct("region").alias("regions"),
    )
