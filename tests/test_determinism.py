"""Draws, splits and samples do not depend on how the data are partitioned."""

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressor

from orderflow.functions.expr import key_hash
from orderflow.models import delay, forest
from orderflow.operators import bridge
from orderflow.plans import catalog, report


@pytest.fixture
def with_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")

    def run(query):
        results = []
        for n in (1, 4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            results.append(sorted(map(tuple, query(n).collect()), key=repr))
        return results

    yield run
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_bridge(spark, sf_dir, with_partitions):
    a, b, c = with_partitions(
        lambda n: catalog.paired(spark, sf_dir).select(*bridge.EVENT_KEY, "shipment_id")
    )
    assert a == b == c


def test_sample(spark, sf_dir, with_partitions):
    pairs = catalog.paired(spark, sf_dir).select(*bridge.EVENT_KEY, "perfect_order")
    a, b, c = with_partitions(lambda n: report.bridge_sample(pairs.repartition(n)))
    assert a == b == c
    assert len(a) == 200
    few = report.bridge_sample(pairs.limit(7))
    assert few.count() == 7


def test_row_numbers_are_dense(spark):
    rows = spark.range(5000).withColumnRenamed("id", "key")
    got = bridge.number_rows(rows.repartition(13), "key", "n").collect()
    assert sorted(r["n"] for r in got) == list(range(5000))
    again = bridge.number_rows(rows.coalesce(1), "key", "n").collect()
    assert {(r["key"], r["n"]) for r in got} == {(r["key"], r["n"]) for r in again}


def test_draws_are_spread_evenly(spark):
    hashed = spark.range(20000).select((key_hash(42, "id") % 10).alias("d"))
    counts = [r["count"] for r in hashed.groupBy("d").count().collect()]
    assert len(counts) == 10
    assert max(counts) < 1.1 * 2000 and min(counts) > 0.9 * 2000


@pytest.mark.parametrize("stratified", [False, True])
def test_split_is_disjoint_and_near_twenty_percent(spark, sf_dir, with_partitions, stratified):
    log = catalog.shipments(spark, sf_dir)

    def parts(n):
        rows = log.repartition(n)
        if stratified:
            return forest.stratified_split(rows, ["shipment_id"], "logistics_delay")
        return forest.split(rows, ["shipment_id"])

    a, b, c = with_partitions(lambda n: parts(n)[1].select("shipment_id"))
    assert a == b == c
    train, test = parts(4)
    assert train.count() + test.count() == log.count()
    assert train.join(test, "shipment_id").count() == 0
    assert 0.17 < test.count() / log.count() < 0.23


def test_every_label_has_its_share_of_test_rows(spark):
    """A rare label, a common one and a missing one: 20 % of each, rounded."""
    sizes = {0: 500, 1: 7, None: 23}
    rows = [(i * 10 + n, label) for n, label in enumerate(sizes) for i in range(sizes[label])]
    df = spark.createDataFrame(rows, "shipment_id bigint, late int")
    train, test = forest.stratified_split(df, ["shipment_id"], "late")
    assert train.columns == test.columns == df.columns
    got = {r["late"]: r["count"] for r in test.groupBy("late").count().collect()}
    assert got == {0: 100, 1: 1, None: 5}
    assert train.union(test).exceptAll(df).isEmpty() and train.count() + test.count() == 530


def test_features_are_spread_over_tasks(spark, sf_dir):
    spread = forest.spread(catalog.shipments(spark, sf_dir), ["shipment_id"], "spread")
    assert spread.rdd.getNumPartitions() > 1


def test_training_tasks_grow_with_rows():
    """Numbers that a task keeps stay bounded."""
    for rows in (100, 7_200_000, 43_200_000, 432_000_000):
        tasks = forest.training_tasks(rows, 20, 200)
        assert rows * 420 / tasks <= forest.TASK_NUMBERS
        assert tasks <= rows * 420 / forest.TASK_NUMBERS + 1


def test_forests_train_in_tasks_by_rows(spark, sf_dir, monkeypatch):
    """The forest gets its rows in as many tasks as their number asks for, none lost."""
    seen = []

    class Watched(RandomForestClassifier):
        def _fit(self, df):
            seen.append((df.rdd.getNumPartitions(), df.count()))
            return super()._fit(df)

    monkeypatch.setattr(delay, "RandomForestClassifier", Watched)
    monkeypatch.setattr(forest, "TASK_NUMBERS", 3_000)
    rows = catalog.shipments(spark, sf_dir)
    size = forest.ForestSize(trees=1, depth=1, exhaustive=True)
    result = delay.train_delay_model(rows, size=size)
    (parts, trained), = seen
    assert trained + result.predictions.count() == rows.count()
    assert parts == -(-trained * (13 + 7 + 2) // 3_000) > 8


def test_single_trees_train_in_small_tasks():
    """A task of one tree keeps fewer numbers than one of a forest: its sums of nodes are small."""
    for rows in (480_000, 28_800_000, 172_800_000):
        assert rows * 62 / forest.training_tasks(rows, 60, 1) <= 10_000_000
        assert rows * 420 / forest.training_tasks(rows, 20, 200) <= 40_000_000


def test_node_ids_are_cached_for_many_nodes_only():
    """With cached node ids a task reads its rows twice, which small trees do not repay."""
    assert not catalog.TREE.settings("all")["cacheNodeIds"]
    assert not catalog.STUMP.settings("all")["cacheNodeIds"]
    assert delay.SIZE.settings("sqrt")["cacheNodeIds"]
    assert forest.ForestSize(1, 12, exhaustive=True).settings("all")["cacheNodeIds"]


def test_delay_features_are_staged_without_a_shuffle(spark, sf_dir, monkeypatch):
    """Marking the split deals the rows, so they need not be dealt before."""
    plans, stage = {}, delay.stage

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return stage(df, name)

    monkeypatch.setattr(delay, "stage", watched)
    monkeypatch.setattr(forest, "stage", watched)
    size = forest.ForestSize(trees=1, depth=1, exhaustive=True)
    delay.train_delay_model(catalog.shipments(spark, sf_dir), size=size)
    assert "Repartition" not in plans["delay-features"]
    assert "Window" in plans["delay-split"]


def test_training_rows_are_sorted_in_their_task(spark, sf_dir, monkeypatch):
    """Rows of like features lie together in every task, and none is lost."""
    seen = []

    class Watched(RandomForestClassifier):
        def _fit(self, df):
            parts = df.select(*delay.NUMERIC, *delay.CATEGORICAL).rdd.glom().collect()
            seen.append([[tuple(r) for r in part] for part in parts])
            return super()._fit(df)

    monkeypatch.setattr(delay, "RandomForestClassifier", Watched)
    rows = catalog.shipments(spark, sf_dir)
    size = forest.ForestSize(trees=9, depth=3)
    result = delay.train_delay_model(rows, size=size)
    (parts,) = seen
    assert sum(map(len, parts)) + result.predictions.count() == rows.count()
    assert all(part == sorted(part) for part in parts)


def test_forest_does_not_depend_on_the_order_of_rows(spark):
    """Draws follow the sorted rows, in whatever order a task gets them; missing values too."""
    rows = [
        (i % 7 * 1.0, i * 37 % 101 / 3, None if i % 11 == 0 else f"c{i % 5}", i * i % 13 * 1.0)
        for i in range(300)
    ]

    def grown(part):
        df = spark.createDataFrame(part, "a double, b double, c string, y double").coalesce(1)
        size = forest.ForestSize(trees=5, depth=4)
        regressor = RandomForestRegressor(labelCol="y", seed=3, **size.settings("all"))
        return forest.fit_forest(df, ["c"], ["a", "b"], regressor, size).stages[-1].toDebugString

    body = [grown(part).split("\n", 1)[1] for part in (rows, rows[::-1], rows[150:] + rows[:150])]
    assert body[0] == body[1] == body[2]


def test_few_rows_train_in_all_tasks(spark, sf_dir, monkeypatch):
    """Rows of one small file are dealt to as many tasks as run at once."""
    seen = []

    class Watched(RandomForestClassifier):
        def _fit(self, df):
            seen.append(df.rdd.glom().map(len).collect())
            return super()._fit(df)

    monkeypatch.setattr(delay, "RandomForestClassifier", Watched)
    rows = catalog.shipments(spark, sf_dir).limit(400).coalesce(1)
    size = forest.ForestSize(trees=1, depth=1, exhaustive=True)
    result = delay.train_delay_model(rows, size=size)
    (parts,) = seen
    assert sum(parts) + result.predictions.count() == 400
    assert len(parts) == spark.sparkContext.defaultParallelism and min(parts) > 0


def test_tasks_of_deep_forests_hold_more():
    """Sums of nodes double with each level, and every task sends them all."""
    assert 7_200_000 * 420 / forest.training_tasks(7_200_000, 20, 200, 8) <= 20_000_000
    shallow, deep = (forest.training_tasks(28_800_000, 60, 150, d) for d in (11, 12))
    assert 0.9 < shallow / (2 * deep) < 1.1
