"""Fitted trees as tables, and exhaustive trees on rows whose best splits are known."""

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from orderflow.models.forest import ForestSize, feature_importance, forest_pipeline
from orderflow.models.trees import node_importance, tree_nodes

ONE = ForestSize(trees=1, depth=2, exhaustive=True)


def fitted(spark, rows, size=ONE, kind=RandomForestRegressor):
    df = spark.createDataFrame(rows, "colour string, width double, y double")
    forest = kind(labelCol="y", seed=1, **size.settings("all"))
    return forest_pipeline(["colour"], ["width"], forest).fit(df)


def test_every_threshold_is_tried(spark):
    rows = [("red", float(i), 10.0 if i > 3456 else 0.0) for i in range(5000)]
    (root, *rest) = tree_nodes(fitted(spark, rows)).orderBy("place").collect()
    assert (root["feature"], root["threshold"], root["rows"]) == ("width", 3456.5, 5000)
    assert [(r["place"], r["prediction"], r["feature"]) for r in rest] == [("TL", 0.0, None), ("TR", 10.0, None)]


def test_one_hot_splits_name_the_value_that_goes_left(spark):
    rows = [(c, float(i % 2), {"red": 1.0, "blue": 7.0, "green": 7.5}[c] + i % 2)
            for c in ("red", "blue", "green") for i in range(50)]
    nodes = {r["place"]: r for r in tree_nodes(fitted(spark, rows)).collect()}
    assert nodes["T"]["feature"] == "colour_red" and nodes["T"]["threshold"] is None
    left_is_red = nodes["T"]["left_value"] == 1.0
    assert nodes["TL" if left_is_red else "TR"]["rows"] == 50
    assert set(nodes) == {"T", "TL", "TR", "TLL", "TLR", "TRL", "TRR"}
    assert all(r["threshold"] in (None, 0.5) for r in nodes.values())


def test_leaves_that_predict_the_same_class_are_one(spark):
    rows = [("red", float(i % 2), float(i % 10 in (0, 2, 5))) for i in range(100)]
    nodes = tree_nodes(fitted(spark, rows, kind=RandomForestClassifier)).collect()
    assert [(r["place"], r["feature"], r["rows"]) for r in nodes] == [("T", None, 100)]


def test_importance_from_nodes_is_the_models(spark):
    rows = [(c, float(i % 37), (3.0 if c == "red" else 1.0) * (i % 37) + i % 5) for c in ("red", "blue") for i in range(200)]
    model = fitted(spark, rows, ForestSize(trees=5, depth=4))
    given = feature_importance(model)
    own = {r["feature"]: r["importance"] for r in node_importance(tree_nodes(model), given).collect()}
    for r in given.collect():
        assert own[r["feature"]] == pytest.approx(r["importance"], abs=1e-9)
    assert tree_nodes(model).select("tree").distinct().count() == 5
    assert tree_nodes(model).agg(F.max(F.length("place"))).first()[0] <= 5


def test_exhaustive_trees_do_not_depend_on_the_seed(spark):
    rows = [("red" if i % 3 else "blue", float(i * 7919 % 1000), float(i * 31 % 17)) for i in range(1000)]
    df = spark.createDataFrame(rows, "colour string, width double, y double")
    found = []
    for seed in (1, 2):
        forest = RandomForestRegressor(labelCol="y", seed=seed, **ONE.settings("all"))
        model = forest_pipeline(["colour"], ["width"], forest).fit(df.repartition(seed * 3))
        found.append(sorted(map(tuple, tree_nodes(model).drop("gain").collect())))
    assert found[0] == found[1]
