"""Delay model: risk that a shipment is late."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame

from orderflow.functions.metrics import classification_metrics
from orderflow.models.forest import (
    SEED,
    ForestSize,
    feature_importance,
    fit_forest,
    positive_probability,
    with_stratum_test,
)
from orderflow.session import delete, stage

# Features and size of the published model.
NUMERIC = (
    "temperature",
    "humidity",
    "waiting_time",
    "asset_utilization",
    "user_transaction_amount",
    "user_purchase_frequency",
    "inventory_level",
)
CATEGORICAL = ("traffic_status", "asset_id")
TARGET = "logistics_delay"
SIZE = ForestSize(trees=200, depth=8)


@dataclass(frozen=True)
class DelayResult:
    model: PipelineModel
    predictions: DataFrame
    metrics: DataFrame
    importance: DataFrame
    scored: DataFrame


def train_delay_model(
    logistics: DataFrame,
    key: str = "shipment_id",
    size: ForestSize = SIZE,
    seed: int = SEED,
) -> DelayResult:
    """Fit on a stratified 80 %, test on the rest, then score every shipment.

    The features are staged, and so is the split, which fitting, testing and reading the
    predictions would else repeat; then the features without the split are deleted. Rows are
    marked where they are, except for those of the buckets that the split cuts.
    """
    spark = logistics.sparkSession
    features = stage(logistics.select(key, TARGET, *CATEGORICAL, *NUMERIC), "delay-features")
    marked = stage(with_stratum_test(features, [key], TARGET, "_tested", seed), "delay-split")
    for file in features.inputFiles():
        delete(spark, file)
    train, test = (marked.where(c).drop("_tested") for c in ("NOT _tested", "_tested"))
    forest = RandomForestClassifier(
        labelCol=TARGET, seed=seed, **size.settings(features_per_split="sqrt")
    )
    model = fit_forest(train, CATEGORICAL, NUMERIC, forest, size, [key])
    predictions = model.transform(test)
    return DelayResult(
        model,
        predictions,
        classification_metrics(predictions, TARGET, "prediction"),
        feature_importance(model),
        score_delay_risk(model, logistics),
    )


def score_delay_risk(model: PipelineModel, logistics: DataFrame) -> DataFrame:
    """All shipments, training rows included, with ``delay_risk_score``."""
    columns = logistics.columns
    return model.transform(logistics).select(
        *columns, positive_probability().alias("delay_risk_score")
    )
