"""Demand model: units sold from price, promotion, calendar and place."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.expr import in_test_split
from orderflow.functions.metrics import forecast_comparison
from orderflow.models.forest import (
    SEED,
    SPARK_ROWS,
    ForestSize,
    feature_importance,
    fit_forest,
    split,
    spread,
)
from orderflow.session import stage

# Features and size of the published model.
NUMERIC = ("price", "discount", "competitor_pricing", "holiday_promotion", "month_num")
CATEGORICAL = (
    "store_id",
    "product_id",
    "category",
    "region",
    "weather_condition",
    "seasonality",
    "day_of_week",
)
TARGET = "units_sold"
BASELINE = "naive_ma7_forecast"
SIZE = ForestSize(trees=150, depth=12)


@dataclass(frozen=True)
class DemandResult:
    """A fitted model with its test rows; what only some callers need is made when asked for."""

    model: PipelineModel
    test: DataFrame
    cleaned: Callable[[], DataFrame]
    keys: Sequence[str]
    seed: int

    @cached_property
    def predictions(self) -> DataFrame:
        return self.model.transform(self.test)

    @cached_property
    def comparison(self) -> DataFrame:
        """Model and moving average over the test rows."""
        test = split(demand_features(self.cleaned(), self.keys), self.keys, self.seed)[1]
        return forecast_comparison(
            self.model.transform(test),
            TARGET,
            {"naive_moving_avg_baseline": BASELINE, "random_forest_model": "prediction"},
        )

    @cached_property
    def importance(self) -> DataFrame:
        return feature_importance(self.model)


def demand_features(retail: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row key, features, target and baseline, which travels along into the test part."""
    columns = [c for c in (*CATEGORICAL, *NUMERIC) if c != "month_num"]
    return retail.withColumn("month_num", F.month("date")).select(
        *dict.fromkeys([*keys, *columns, "month_num", TARGET, BASELINE])
    )


def train_demand_model(
    retail: DataFrame,
    keys: Sequence[str],
    size: ForestSize = SIZE,
    seed: int = SEED,
    numeric: Sequence[str] = NUMERIC,
    cleaned: Callable[[], DataFrame] | None = None,
) -> DemandResult:
    """Fit on 80 % of the rows and compare with the moving average on the rest.

    Fitting reads its input several times, so the features are staged with the mark of the
    split. It needs no moving average: ``cleaned`` gives the same rows with it, for the
    comparison, where ``retail`` is without.
    """
    features = demand_features(retail.withColumn(BASELINE, F.lit(None).cast("double")), keys)
    marked = features.drop(BASELINE).withColumn("_tested", in_test_split(seed, *keys))
    staged = stage(marked, "demand-features")
    if staged.count() <= SPARK_ROWS:
        staged = spread(staged, keys, "demand-features")
    train, test = (staged.where(c).drop("_tested") for c in ("NOT _tested", "_tested"))
    forest = RandomForestRegressor(
        labelCol=TARGET, seed=seed, **size.settings(features_per_split="all")
    )
    model = fit_forest(train, CATEGORICAL, numeric, forest, size, keys)
    return DemandResult(model, test, cleaned or (lambda: retail), keys, seed)
