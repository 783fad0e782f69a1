"""Forests grown from binned rows: the same trees as Spark's, whatever the tasks and blocks."""

import os

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from orderflow.models import delay, demand, forest, grower
from orderflow.models.forest import ForestSize
from orderflow.models.trees import tree_nodes
from orderflow.operators.bridge import number_within

KINDS = {"numbers": RandomForestRegressor, "classes": RandomForestClassifier}


def table(spark, kind, n=700):
    """Rows with a missing category and targets that are sums of few numbers, so that sums are exact."""
    rows = [
        (i, None if i % 17 == 0 else f"c{i * 7 % 5}", "left" if i * i % 11 < 4 else "right", float(i * 37 % 101),
         i * 31 % 7, float((i * 37 % 101 > 40) + (i * 7 % 5 == 2) * (i % 3)))
        for i in range(n)
    ]
    y = F.col("y") if kind == "numbers" else (F.col("y") > 1).cast("int").alias("y")
    return spark.createDataFrame(rows, "k int, c string, s string, a double, b int, y double").select(
        "k", "c", "s", "a", "b", y)


def fitted(df, size, kind, strategy="all", keys=("k",), seed=3):
    estimator = KINDS[kind](labelCol="y", seed=seed, **size.settings(strategy))
    return forest.fit_forest(df, ["c", "s"], ["a", "b"], estimator, size, keys)


def body(model):
    return model.stages[-1].toDebugString.split("\n", 1)[1]


@pytest.mark.parametrize("kind", KINDS)
def test_tree_is_the_one_that_spark_grows(spark, monkeypatch, kind):
    """Places, splits, rows, gains and values of all nodes, joined leaves included."""
    df, size, found = table(spark, kind), ForestSize(1, 4, exhaustive=True), []
    for most in (10**9, 0):
        monkeypatch.setattr(forest, "SPARK_ROWS", most)
        nodes = tree_nodes(fitted(df, size, kind))
        rounded = nodes.withColumns({c: F.round(c, 9) for c in ("gain", "prediction")}).drop("tree")
        found.append(sorted(map(tuple, rounded.collect()), key=repr))
    assert found[0] == found[1] and len(found[0]) > 9


@pytest.mark.parametrize("kind", KINDS)
def test_forest_does_not_depend_on_tasks_blocks_or_order(spark, monkeypatch, kind):
    """Kept rows, or level by level in blocks; nodes in parts; rows in another order; cells not shared."""
    monkeypatch.setattr(forest, "SPARK_ROWS", 0)
    size, found = ForestSize(7, 5), []
    for kept, block, sums, task, bins, df in (
        (10**6, 10**6, 10**6, 10**7, 256, table(spark, kind).coalesce(1)),
        (10**6, 10**6, 300, 1500, 256, table(spark, kind).coalesce(1)),
        (0, 50, 300, 1500, 4, table(spark, kind).orderBy(F.desc("a"), "b").coalesce(1)),
    ):
        monkeypatch.setattr(grower, "SUMS_OF_TASK", task)
        monkeypatch.setattr(grower, "CELL_BINS", bins)
        monkeypatch.setattr(grower, "KEEP_ROWS", kept)
        monkeypatch.setattr(grower, "SUMS_AT_ONCE", sums)
        monkeypatch.setattr(grower, "BLOCK_ROWS", block)
        found.append(body(fitted(df, size, kind, "sqrt")))
    assert found[0] == found[1] == found[2]


def test_rows_of_few_trees_are_added_up_where_they_are(spark, monkeypatch):
    """A tree of many rows is grown by all tasks; it is the tree that one task grows."""
    monkeypatch.setattr(forest, "SPARK_ROWS", 0)
    size, found, seen = ForestSize(1, 4, exhaustive=True), [], []
    real = grower.Sums.join
    monkeypatch.setattr(grower.Sums, "join", lambda self, other: (seen.append(1), real(self, other)))
    for kept in (10**6, 0):
        monkeypatch.setattr(grower, "KEEP_ROWS", kept)
        found.append(body(fitted(table(spark, "numbers").repartition(3), size, "numbers")))
    assert found[0] == found[1] and len(seen) >= 2


def test_forest_has_all_trees_and_their_features(spark, monkeypatch):
    monkeypatch.setattr(forest, "SPARK_ROWS", 0)
    model = fitted(table(spark, "numbers"), ForestSize(9, 6), "numbers")
    grown = model.stages[-1]
    assert (grown.getNumTrees, grown.numFeatures, grown.getMaxDepth()) == (9, 9, 6)
    assert len({t.toDebugString.split("\n", 1)[1] for t in grown.trees}) == 9
    shares = {r["feature"]: r["importance"] for r in forest.feature_importance(model).collect()}
    assert set(shares) == {*(f"c_c{i}" for i in range(5)), "s_left", "s_right", "a", "b"}
    assert sum(shares.values()) == pytest.approx(1) and shares["a"] == max(shares.values())
    roots = tree_nodes(model).where("place = 'T'")
    assert roots.agg(F.avg("rows")).first()[0] == pytest.approx(700, rel=0.1)
    assert roots.select("rows").distinct().count() > 1
    for row in model.transform(table(spark, "numbers").limit(20)).collect():
        assert row["prediction"] == pytest.approx(sum(t.predict(row["features"]) for t in grown.trees) / 9)


def test_draws_follow_a_poisson_distribution_and_differ_by_tree():
    features = (grower.Feature(0, 2, np.zeros(1)),)
    recipe = grower.Recipe(features, (2,), 0, 1, 5, True, False, 1)
    hashes = np.random.default_rng(1).integers(2**32, size=200_000, dtype=np.uint32)
    one, two = (grower.draws(recipe, t, hashes).astype(float) for t in (0, 1))
    assert one.mean() == pytest.approx(1, abs=0.02) and one.var() == pytest.approx(1, abs=0.03)
    assert (one == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)
    assert abs(np.corrcoef(one, two)[0, 1]) < 0.02
    assert (grower.draws(recipe, 0, hashes) == one).all()


def test_equal_rows_are_drawn_apart(spark, monkeypatch):
    """Rows that agree in keys and values are still drawn one by one."""
    monkeypatch.setattr(forest, "SPARK_ROWS", 0)
    df = spark.createDataFrame([(None, "c", "s", float(i % 2), 1, float(i % 2)) for i in range(1000)],
                               "k int, c string, s string, a double, b int, y double").coalesce(1)
    roots = tree_nodes(fitted(df, ForestSize(20, 1), "numbers")).where("place = 'T'").select("rows").collect()
    assert all(850 < r["rows"] < 1150 for r in roots) and len({r["rows"] for r in roots}) > 5


@pytest.mark.parametrize("column", ["a", "y"])
def test_missing_numbers_stop_training(spark, monkeypatch, column):
    monkeypatch.setattr(forest, "SPARK_ROWS", 0)
    df = table(spark, "numbers").withColumn(column, F.expr(f"if(k = 5, null, {column})"))
    with pytest.raises(Exception, match="a training row"):
        fitted(df, ForestSize(2, 2), "numbers")


def test_features_of_many_values_are_cut_at_quantiles(spark):
    df = spark.range(5000).select(F.col("id").cast("double").alias("a"), (F.col("id") % 9).alias("b"))
    many, few = grower.thresholds(df, ["a", "b"], 32)
    assert len(many) == 31 and np.abs(np.diff(many) - 156).max() < 20
    assert few.tolist() == [i + 0.5 for i in range(8)]


def test_split_marks_rows_as_their_numbers_do(spark):
    """The same rows as by numbering all of them; only rows of the buckets that are cut are numbered."""
    df = spark.range(6000).select("id", F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 3).alias("y"))
    got = forest.with_stratum_test(df, ["id"], "y", "t")
    numbered = number_within(df, "y", ["id"], "n")
    sizes = df.groupBy(F.col("y").alias("g")).agg(F.floor(F.count("*") * 0.2 + 0.5).alias("m"))
    wanted = numbered.join(sizes, F.col("y").eqNullSafe(F.col("g"))).select("id", "y", (F.col("n") < F.col("m")).alias("t"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)


def test_training_leaves_one_copy_of_the_shipments(spark, monkeypatch):
    """Large inputs: no cached rows, no second copy of the features, binned rows instead."""
    monkeypatch.setattr(forest, "SPARK_ROWS", 0)
    paths = {}
    real = delay.stage

    def watched(df, name):
        paths[name] = real(df, name)
        return paths[name]

    monkeypatch.setattr(delay, "stage", watched)
    rows = spark.range(900).select(
        F.col("id").alias("shipment_id"), (F.col("id") % 3 == 0).cast("int").alias("logistics_delay"),
        F.concat(F.lit("t"), F.col("id") % 3).alias("traffic_status"), F.concat(F.lit("a"), F.col("id") % 4).alias("asset_id"),
        *[(F.col("id") % (7 + i)).cast("double").alias(c) for i, c in enumerate(delay.NUMERIC)])
    result = delay.train_delay_model(rows, size=ForestSize(5, 4))
    files = {name: [f.removeprefix("file:").replace("//", "/") for f in df.inputFiles()] for name, df in paths.items()}
    assert not any(os.path.exists(f) for f in files["delay-features"])
    assert all(os.path.exists(f) for f in files["delay-split"])
    assert result.predictions.count() == 180 and result.scored.count() == 900
    assert result.metrics.where("metric = 'Accuracy'").first()["value"] == 1
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_training_asks_for_no_moving_average(spark, monkeypatch):
    """The moving average is made for the comparison alone, from the rows given for it."""
    rows = spark.range(800).select(
        F.col("id"), F.expr("date_add(date'2024-01-01', cast(id % 300 as int))").alias("date"),
        *[F.concat(F.lit(c[0]), F.col("id") % (i + 2)).alias(c) for i, c in enumerate(demand.CATEGORICAL)],
        *[(F.col("id") % (3 + i)).cast("double").alias(c) for i, c in enumerate(demand.NUMERIC) if c != "month_num"],
        (F.col("id") % 5).cast("double").alias(demand.TARGET))
    asked = []
    for most in (0, 10**9):
        monkeypatch.setattr(forest, "SPARK_ROWS", most)
        result = demand.train_demand_model(
            rows, ["id"], size=ForestSize(5, 4),
            cleaned=lambda: (asked.append(1), rows.withColumn(demand.BASELINE, F.lit(2.0)))[1])
        assert result.importance.count() > 10 and not asked
        n = result.predictions.where("prediction BETWEEN 0 AND 4").count()
        assert 100 < n < 220
        assert [r["metric"] for r in result.comparison.collect()] == ["MAE", "WAPE (%)"] and asked.pop()
