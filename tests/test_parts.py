"""Deep forests that are grown in parts at once, and work beside other work."""

import threading

import pytest
from pyspark.ml.regression import RandomForestRegressor

from orderflow.models import forest
from orderflow.models.trees import tree_nodes
from orderflow.operators import trailing
from orderflow.session import branches


def test_parts_take_the_tasks_that_run_at_once():
    """Few rows grow many parts, more rows fewer; never more tasks at once, nor larger ones."""
    size = forest.ForestSize(trees=150, depth=12)
    seen = []
    for rows in (1_000, 480_000, 2_000_000, 28_800_000):
        parts = forest.forest_parts(rows, 60, size, 12)
        trees = -(-150 // parts)
        tasks = forest.training_tasks(rows, 60, trees, 12)
        assert parts == 1 or parts * tasks <= 12
        assert rows * (60 + 2 * trees) / tasks <= 2 * forest.TASK_NUMBERS
        seen.append(parts)
    assert seen[0] == 12 and seen[1] > 1 and seen[-1] == 1 and seen == sorted(seen, reverse=True)
    assert forest.forest_parts(480_000, 60, forest.ForestSize(trees=200, depth=8), 12) == 1
    assert forest.forest_parts(480_000, 60, forest.ForestSize(trees=1, depth=12), 12) == 1


def test_forest_in_parts_is_one_forest(spark, monkeypatch):
    """All trees are there, differ from each other, split one-hot slots, and predict as one mean."""
    monkeypatch.setattr(forest, "DEEP", 3)
    rows = [(f"c{i % 5}", i * 37 % 101 / 3, i * i % 13 + 20.0 * (i % 5 == 2)) for i in range(600)]
    df = spark.createDataFrame(rows, "c string, a double, y double")
    size = forest.ForestSize(trees=9, depth=3)
    regressor = RandomForestRegressor(labelCol="y", seed=3, **size.settings("all"))
    fits = []
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, *a, fit=RandomForestRegressor.fit: (
        fits.append((self.getNumTrees(), self.getSeed())), fit(self, *a))[1])
    model = forest.fit_forest(df, ["c"], ["a"], regressor, size)
    assert len(fits) > 1 and sum(n for n, _ in fits) == 9 and len({s for _, s in fits}) == len(fits)
    grown = model.stages[-1]
    assert grown.getNumTrees == 9 and len({t.toDebugString.split("\n", 1)[1] for t in grown.trees}) == 9
    assert sum(forest.feature_importance(model).toPandas()["importance"]) == pytest.approx(1)
    nodes = tree_nodes(model)
    assert nodes.select("tree").distinct().count() == 9
    assert nodes.where("feature = 'c_c2' AND left_value IS NOT NULL").count() > 0
    assert nodes.where("place = 'T'").agg({"rows": "avg"}).first()[0] == pytest.approx(600, rel=0.1)
    for row in model.transform(df.limit(20)).select("features", "prediction").collect():
        mean = sum(t.predict(row["features"]) for t in grown.trees) / 9
        assert row["prediction"] == pytest.approx(mean)


def test_branches_run_beside_each_other(spark):
    """Each waits for the other; a branch's error is raised, and its session is the caller's."""
    meet = threading.Barrier(2, timeout=60)

    def work(n):
        meet.wait()
        return spark.range(n).count()

    with branches(spark) as branch:
        both = [branch(lambda n=n: work(n)) for n in (3, 4)]
        assert [b.result() for b in both] == [3, 4]
        failed = branch(lambda: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            failed.result()


def test_window_tasks_grow_with_rows(spark, monkeypatch):
    """Many rows meet their windows in more tasks than the session's, with the same means, in one shuffle."""
    rows = [(f"s{i % 50}" if i % 7 else None, i // 50, float(i * i % 23)) for i in range(3000)]
    df = spark.createDataFrame(rows, "s string, day int, v double")

    def means(most):
        monkeypatch.setattr(trailing, "WINDOW_ROWS", most)
        got = trailing.with_trailing_means(df, ["s"], ["day"], "v", long_rows=100, rows_at_most=3000)
        plan = got._jdf.queryExecution().executedPlan().toString()
        return sorted(map(tuple, got.collect()), key=repr), plan

    (few, before), (many, after) = means(10**9), means(100)
    assert few == many
    assert "_apart" in before and ", 30)" not in before
    assert after.count(", 30)") == 1 and after.count("hashpartitioning") == before.count("hashpartitioning")
