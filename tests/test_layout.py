"""The layout of the stored row-level tables: what a filter reads of them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderflow.plans import report
from orderflow.plans.report import FilterSpec
from orderflow.sources import tables


def rows_scanned(df):
    """Rows that the file scan hands on, by Spark's own count."""
    query = df._jdf.queryExecution()
    query.executedPlan().executeCollect()
    plan = query.executedPlan()
    while plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    leaf = leaves.apply(0)
    while leaf.nodeName().endswith("QueryStage"):
        leaf = leaf.plan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    out = f"file:{tmp_path_factory.mktemp('layout')}"
    day = F.date_add(F.lit(dt.date(2022, 1, 1)), (F.col("id") % 59).cast("int"))
    rows = spark.range(200_000).select(
        day.alias("date"), F.date_format(day, "yyyy-MM").alias("month"),
        F.concat(F.lit("R"), F.xxhash64("id") % 5).alias("region"),
        F.concat(F.lit("C"), F.xxhash64("id", F.lit(1)) % 4).alias("category"),
        F.xxhash64("id", F.lit(2)).cast("double").alias("revenue"),
        F.lit(1.0).alias("units_sold"), F.lit(0).alias("stockout_occurred"))
    tables.write_table(rows, out, "retail_cleaned", row_group=100_000)
    return out


def test_filters_skip_row_groups(spark, stored):
    table = tables.read_table(spark, stored, "retail_cleaned").select(
        "date", "month", "region", "category", "revenue")
    whole = rows_scanned(table.where("revenue IS NOT NULL"))
    assert whole == 200_000
    by_region = rows_scanned(FilterSpec(regions=["R1"]).retail(table))
    by_both = rows_scanned(FilterSpec(regions=["R1"], categories=["C2"]).retail(table))
    by_month = rows_scanned(FilterSpec(regions=["R1"], end=dt.date(2022, 1, 31)).retail(table))
    assert by_region < 0.4 * whole and by_both < 0.6 * by_region and by_month < 0.7 * by_region


def test_span_of_dates_reads_no_column(spark, stored):
    span = report.stored_date_span(spark, stored)
    plan = span._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(date), MAX(date)]" in plan
    assert tuple(span.first()) == (dt.date(2022, 1, 1), dt.date(2022, 2, 28))
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_span_of_an_empty_table(spark, stored, tmp_path):
    none = tables.read_table(spark, stored, "retail_cleaned").where("date < DATE '1990-01-01'")
    none.drop("month").write.parquet(f"file:{tmp_path}/retail_cleaned")
    assert tuple(report.stored_date_span(spark, f"file:{tmp_path}").first()) == (None, None)
