"""Forecast and classification metrics as aggregate expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.expr import percent


def mae(actual: Column, forecast: Column) -> Column:
    return F.avg(F.abs(actual - forecast))


def wape(actual: Column, forecast: Column) -> Column:
    """Absolute error over actual volume, in percent; NULL on zero volume."""
    return percent(F.try_divide(F.sum(F.abs(actual - forecast)), F.sum(actual)))


def accuracy(label: Column, prediction: Column) -> Column:
    return F.avg((label == prediction).cast("int"))


def f1_positive(label: Column, prediction: Column) -> Column:
    """F1 of class 1 from its confusion counts; 0 when the class never occurs."""

    def hits(condition: Column) -> Column:
        return F.count_if(condition)

    tp = hits((label == 1) & (prediction == 1))
    fp = hits((label != 1) & (prediction == 1))
    fn = hits((label == 1) & (prediction != 1))
    return F.coalesce(F.try_divide(2.0 * tp, 2 * tp + fp + fn), F.lit(0.0))


def forecast_comparison(df: DataFrame, actual: str, forecasts: Mapping[str, str]) -> DataFrame:
    """MAE and WAPE of several forecasts: one row per metric, one column per forecast.

    Every metric comes out of a single aggregation over ``df``; ``forecasts``
    maps output column to forecast column.
    """
    y = F.col(actual)
    measures: list[Column] = []
    for name, column in forecasts.items():
        measures.append(mae(y, F.col(column)).alias(f"mae_{name}"))
        measures.append(wape(y, F.col(column)).alias(f"wape_{name}"))
    row = df.agg(*measures)
    return row.select(
        F.stack(
            F.lit(2),
            F.lit("MAE"),
            *[F.col(f"mae_{n}") for n in forecasts],
            F.lit("WAPE (%)"),
            *[F.col(f"wape_{n}") for n in forecasts],
        ).alias("metric", *forecasts)
    )


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    row = df.agg(accuracy(y, p).alias("acc"), f1_positive(y, p).alias("f1"))
    return row.select(
        F.stack(
            F.lit(2), F.lit("Accuracy"), F.col("acc"), F.lit("F1_Score"), F.col("f1")
        ).alias("metric", "value")
    )


def melt_metric(comparison: DataFrame, metric: str) -> DataFrame:
    """One metric of a comparison table as (metric, model, value) rows."""
    models = [c for c in comparison.columns if c != "metric"]
    return comparison.where(F.col("metric") == metric).unpivot(["metric"], models, "model", "wape")
