"""One-hot encoding by a distributed dictionary against Spark's own indexer."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orderflow.models import encoding
from orderflow.models.encoding import CategoryEncoder, category_dictionary


def spark_own(columns):
    """The form that gathers all values in the driver."""
    index = StringIndexer(inputCols=columns, outputCols=[f"{c}_i" for c in columns],
                          handleInvalid="keep", stringOrderType="alphabetAsc")
    return Pipeline(stages=[index, OneHotEncoder(
        inputCols=[f"{c}_i" for c in columns], outputCols=[f"{c}_onehot" for c in columns], dropLast=True)])


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_slots_equal_those_of_the_indexer(spark, monkeypatch, broadcast):
    monkeypatch.setattr(encoding, "BROADCAST_VALUES", broadcast)
    train = spark.createDataFrame(
        [("b", "x y"), ("a", "Z"), ("c", None), ("a", "é"), (None, "0"), ("B", " ")], "v string, w string")
    rows = train.unionByName(spark.createDataFrame([("z", "q"), ("a", None)], train.schema))
    results = []
    for encoder in (CategoryEncoder(["v", "w"]), spark_own(["v", "w"])):
        got = encoder.fit(train).transform(rows).select(
            "v", "w", *[vector_to_array(f"{c}_onehot").alias(c + "1") for c in "vw"])
        results.append(sorted(map(repr, got.collect())))
    assert results[0] == results[1]


def test_slots_of_200_000_values_equal_those_of_the_indexer(spark):
    rows = spark.range(200_000).select(
        F.concat(F.lit("value "), F.md5(F.col("id").cast("string"))).alias("v"), F.lit("one").alias("w"))
    model = CategoryEncoder(["v", "w"]).fit(rows)
    assert model.sizes == {"v": 200_000, "w": 1}
    indexer = StringIndexer(inputCol="v", outputCol="i", stringOrderType="alphabetAsc").fit(rows)
    same = indexer.transform(rows).join(model.slots("v"), F.col("v") == F.col("value"))
    assert same.where(F.col("i") == F.col("slot")).count() == 200_000
    got = model.transform(rows.limit(50)).select("v_onehot").collect()
    assert all(r["v_onehot"].size == 200_000 and len(r["v_onehot"].indices) == 1 for r in got)
    names = model.feature_names()
    assert names.count() == 200_001 and names.agg(F.max("index")).first()[0] == 200_000


def test_slots_do_not_depend_on_the_ranges(spark):
    rows = spark.range(3000).select(F.md5((F.col("id") % 700).cast("string")).alias("v"))
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(sorted(map(tuple, category_dictionary(rows, ["v"]).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]
    assert [r[2] for r in found[0]] == list(range(700))


def test_a_column_without_values_and_numbers_as_categories(spark):
    rows = spark.createDataFrame([(None, 3), (None, 1), (None, None)], "v string, k int")
    got = CategoryEncoder(["v", "k"]).fit(rows).transform(rows).select("k", "v_onehot", vector_to_array("k_onehot").alias("x"))
    assert {(r["k"], tuple(r["x"]), r["v_onehot"].size) for r in got.collect()} == {
        (3, (0.0, 1.0), 0), (1, (1.0, 0.0), 0), (None, (0.0, 0.0), 0)}
