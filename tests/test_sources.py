"""CSV input with its spellings of missing values, result tables, and the whole job."""

import csv
import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobs.run_pipeline import parse
from orderflow.models.forest import ForestSize
from orderflow.operators.retail import with_series_measures
from orderflow.plans import catalog, report
from orderflow.plans.pipeline import run_pipeline
from orderflow.session import shared_dir, stage, staging_area
from orderflow.sources import tables
from orderflow.sources.csv_source import (
    parse_columns,
    read_logistics_csv,
    read_retail_csv,
    with_input_position,
)
from orderflow.sources.schemas import MISSING_TEXTS, column_name, heading

RETAIL_ROW = {
    "Date": "2022-01-03", "Store ID": "S001", "Product ID": "P0001", "Category": "Toys",
    "Region": "North", "Inventory Level": "231", "Units Sold": "127", "Units Ordered": "55",
    "Demand Forecast": "135.47", "Price": "33.5", "Discount": "20", "Weather Condition": "Rainy",
    "Holiday/Promotion": "0", "Competitor Pricing": "29.69", "Seasonality": "Autumn",
}
SHIPMENT_ROW = {
    "Timestamp": "2024-03-20 00:11:14", "Asset_ID": "Truck_7", "Shipment_Status": "Delayed",
    "Traffic_Status": "Detour", "Waiting_Time": "38", "Asset_Utilization": "60.1",
    "Logistics_Delay": "1", "Logistics_Delay_Reason": "None", "Temperature": "27.0",
    "Humidity": "67.8", "User_Transaction_Amount": "320", "User_Purchase_Frequency": "4",
    "Inventory_Level": "390",
}


def write_csv(path: Path, rows, header=None):
    names = list(rows[0])
    with path.open("w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header or names)
        out.writerows([r[n] for n in names] for r in rows)
    return f"file:{path}"


def test_columns_are_found_by_name_not_by_position(spark, tmp_path):
    row = dict(reversed(RETAIL_ROW.items()))
    header = [f"  {n} " for n in row]
    got = read_retail_csv(spark, write_csv(tmp_path / "r.csv", [row], header)).first()
    assert got["date"] == dt.date(2022, 1, 3)
    assert (got["units_sold"], got["price"], got["holiday_promotion"]) == (127.0, 33.5, 0)
    assert got["product_id"] == "P0001"


def test_other_columns_pass_through(spark, tmp_path):
    path = write_csv(tmp_path / "r.csv", [{**RETAIL_ROW, "Promo Code": "x1"}])
    assert read_retail_csv(spark, path).first()["promo_code"] == "x1"


def test_quotes_inside_a_field(spark, tmp_path):
    text = 'Toys, "soft" and \\hard'
    path = write_csv(tmp_path / "r.csv", [{**RETAIL_ROW, "Category": text}])
    assert read_retail_csv(spark, path).first()["category"] == text


def test_absent_column_is_an_error(spark, tmp_path):
    row = {k: v for k, v in RETAIL_ROW.items() if k != "Price"}
    with pytest.raises(ValueError, match="price"):
        read_retail_csv(spark, write_csv(tmp_path / "r.csv", [row]))


def test_every_spelling_of_missing_becomes_null(spark, tmp_path):
    rows = [
        {**RETAIL_ROW, "Category": t, "Inventory Level": t, "Holiday/Promotion": t}
        for t in MISSING_TEXTS
    ]
    back = read_retail_csv(spark, write_csv(tmp_path / "r.csv", rows))
    assert back.count() == len(MISSING_TEXTS)
    columns = ("category", "inventory_level", "holiday_promotion")
    nulls = back.select(*[F.count_if(F.col(c).isNotNull()).alias(c) for c in columns]).first()
    assert tuple(nulls) == (0, 0, 0)


def test_flags_written_as_decimals(spark, tmp_path):
    path = write_csv(tmp_path / "r.csv", [{**RETAIL_ROW, "Holiday/Promotion": "1.0"}])
    assert read_retail_csv(spark, path).first()["holiday_promotion"] == 1


def test_shipment_rows(spark, tmp_path):
    path = write_csv(tmp_path / "l.csv", [SHIPMENT_ROW] * 3)
    scanned = stage(read_logistics_csv(spark, path, located=True), "scan")
    keyed = with_input_position(scanned, "shipment_id")
    rows = keyed.orderBy("shipment_id").collect()
    assert rows[0]["ts"] == dt.datetime(2024, 3, 20, 0, 11, 14)
    assert rows[0]["logistics_delay_reason"] is None
    assert [r["shipment_id"] for r in rows] == [0, 1, 2]


def test_positions_do_not_depend_on_the_splits(spark, tmp_path):
    """Two files, the larger one last, under two split sizes: same keys in file order."""
    for name, n in (("a", 30), ("b", 900)):
        write_csv(tmp_path / f"{name}.csv", [
            {**SHIPMENT_ROW, "Waiting_Time": str(i), "Asset_ID": name} for i in range(n)])
    expected = [("a", float(i)) for i in range(30)] + [("b", float(i)) for i in range(900)]
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    try:
        for size in ("128m", "7k", "20k"):
            spark.conf.set(setting, size)
            scanned = stage(read_logistics_csv(spark, f"file:{tmp_path}", located=True), "scan")
            rows = with_input_position(scanned, "shipment_id").orderBy("shipment_id").collect()
            assert [(r["asset_id"], r["waiting_time"]) for r in rows] == expected
            assert [r["shipment_id"] for r in rows] == list(range(930))
    finally:
        spark.conf.set(setting, before)


def test_fractional_flags_are_an_error(spark, tmp_path):
    path = write_csv(tmp_path / "r.csv", [{**RETAIL_ROW, "Holiday/Promotion": "0.7"}])
    with pytest.raises(Exception, match="not a whole number"):
        read_retail_csv(spark, path).collect()


def test_a_blank_is_text_not_missing(spark, tmp_path):
    path = write_csv(tmp_path / "r.csv", [{**RETAIL_ROW, "Category": " "}])
    assert read_retail_csv(spark, path).first()["category"] == " "


def test_typed_tie_breakers():
    names, types = parse_columns(["row_id", "line:int", "key:bigint"])
    assert names == ["row_id", "line", "key"] and types.simpleString() == "struct<line:int,key:bigint>"


def test_staged_tables_of_an_area_are_deleted(spark):
    with staging_area(spark):
        inside = stage(spark.range(5), "numbers")
        folder = Path(inside.inputFiles()[0].removeprefix("file:")).parent
        assert folder.exists()
    assert not folder.exists()


def test_malformed_number_is_an_error(spark, tmp_path):
    path = write_csv(tmp_path / "r.csv", [{**RETAIL_ROW, "Price": "12,x"}])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_retail_csv(spark, path).collect()


def test_names_and_headings():
    assert column_name(" Holiday/Promotion ") == "holiday_promotion"
    assert column_name("Timestamp") == "ts"
    assert heading("avg_days_of_supply") == "Avg_Days_of_Supply"
    assert heading("perfect_order_rate") == "Perfect_Order_Rate"


def test_stage_reads_back_the_same_rows(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    staged = stage(df, "numbers")
    assert shared_dir(spark).removeprefix("file:") in staged.inputFiles()[0]
    assert staged.exceptAll(df).isEmpty() and staged.count() == 100


def test_job_arguments():
    args = parse([])
    assert (args.demand_trees, args.demand_depth) == (150, 12)
    assert (args.delay_trees, args.delay_depth) == (200, 8)
    assert args.out_dir == "data_processed"
    assert parse(["--retail_csv", "a", "--tie_breakers", "x", "y"]).tie_breakers == ["x", "y"]


@pytest.fixture(scope="module")
def results(spark, sf_dir, tmp_path_factory):
    out = f"file:{tmp_path_factory.mktemp('results')}"
    run_pipeline(
        spark,
        catalog.export_retail(spark, sf_dir),
        catalog.export_logistics(spark, sf_dir),
        out,
        tie_breakers=catalog.TYPED_TIE_BREAKERS,
        demand_size=ForestSize(5, 4),
        delay_size=ForestSize(10, 4),
        long_rows=40,
    )
    return out


def columns_of(spark, out, name):
    return tables.read_table(spark, out, name)


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_job_writes_seventeen_tables(spark, results):
    assert len(tables.TABLES) == 17
    for name in tables.TABLES:
        assert not columns_of(spark, results, name).isEmpty(), name


def test_totals_agree_across_tables(spark, results):
    read = lambda name: columns_of(spark, results, name)
    by_month, by_category = read("retail_monthly_overall"), read("retail_category_summary")
    units = total(by_month, "units_sold")
    assert units == total(by_category, "total_units_sold")
    assert units == total(read("retail_kpi_daily"), "units_sold")
    assert units == total(read("retail_kpi_monthly"), "units_sold")
    assert total(by_month, "revenue") == pytest.approx(total(by_category, "total_revenue"))
    for measure in ("shipments", F.col("shipments") * F.col("on_time_rate"),
                    F.col("shipments") * F.col("avg_waiting_time")):
        by_truck, by_traffic, by_month = (
            read(n).agg(F.sum(measure)).first()[0]
            for n in ("logistics_asset_kpi", "logistics_traffic_kpi", "logistics_monthly_otd")
        )
        assert by_truck == pytest.approx(by_traffic) == pytest.approx(by_month)
    assert total(read("logistics_delay_reason_kpi"), "share_of_delays_pct") == pytest.approx(
        100, abs=0.3
    )
    events = total(read("perfect_order_by_category"), "replenishment_events")
    assert events == read("bridge_perfect_order").count()
    for name in ("model_forecast_feature_importance", "model_delay_feature_importance"):
        assert total(read(name), "importance") == pytest.approx(1.0)
    heavy = read("logistics_traffic_kpi").where("traffic_status = 'Heavy'").first()
    assert heavy["on_time_rate"] == 0.0


def test_job_on_cut_series_equals_uncut_series(spark, results):
    """The job cut its series after 40 rows; here they are computed in one piece."""
    written = columns_of(spark, results, "retail_cleaned")
    derived = ("avg_daily_sales_7d", "naive_ma7_forecast", "days_of_supply", "overstock_flag")
    keys = ("store_id", "product_id", "date", "row_id")
    whole = with_series_measures(
        written.drop(*derived),
        ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        rows_at_most=written.count(),
    )
    assert written.groupBy("store_id", "product_id").count().where("count > 40").count() > 10
    left, right = written.select(*keys, *derived), whole.select(*keys, *derived)
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_bridge_carries_the_risk_score(spark, results):
    bridge = columns_of(spark, results, "bridge_perfect_order")
    assert {"delay_risk_score", "delivered_on_time", "perfect_order"} <= set(bridge.columns)


def test_csv_exports_carry_published_headings(spark, results):
    def header(name):
        files = list(Path(results.removeprefix("file:"), "csv", name).glob("part-*.csv"))
        if name in tables.SMALL_TABLES:
            assert len(files) == 1
        files = [f for f in sorted(files) if f.stat().st_size]
        return files[0].read_text().splitlines()[0]

    # Headings of the published result files.
    assert header("retail_monthly_overall") == (
        "Month,Revenue,Units_Sold,Forecast_WAPE_Pct,Stockout_Rate_Pct,Avg_Days_of_Supply"
    )
    assert header("retail_category_summary") == (
        "Category,Total_Revenue,Total_Units_Sold,Forecast_MAPE,Stockout_Rate,Overstock_Rate,"
        "Avg_Days_of_Supply"
    )
    assert header("retail_promo_lift") == (
        "Category,Avg_Units_No_Promo,Avg_Units_With_Promo,Promo_Lift_Pct"
    )
    assert header("logistics_asset_kpi") == (
        "Asset_ID,Shipments,On_Time_Rate,Avg_Waiting_Time,Avg_Asset_Utilization,Delivered_Rate"
    )
    assert header("logistics_delay_reason_kpi") == "Delay_Reason,Share_of_Delays_Pct"
    assert header("model_forecast_comparison") == (
        "Metric,Naive_MovingAvg_Baseline,RandomForest_Model"
    )
    assert header("perfect_order_by_category") == (
        "Category,Replenishment_Events,Perfect_Order_Rate,Stockout_Free_Rate,On_Time_Rate"
    )


def test_exported_rows_keep_their_order(spark, results):
    folder = Path(results.removeprefix("file:"), "csv", "retail_category_summary")
    with next(folder.glob("part-*.csv")).open() as f:
        revenue = [float(r["Total_Revenue"]) for r in csv.DictReader(f)]
    assert revenue == sorted(revenue, reverse=True)


def test_report_runs_on_the_written_tables(spark, results):
    loaded = tables.keep_in_memory(tables.read_report_tables(spark, results))
    assert len(loaded) == 15
    cards = report.kpi_cards(
        catalog.FILTERS.retail(loaded["retail_cleaned"]),
        catalog.FILTERS.logistics(loaded["logistics_cleaned"]),
        catalog.FILTERS.by_category(loaded["bridge_perfect_order"]),
    ).first()
    assert cards["total_revenue"] > 0 and 0 <= cards["perfect_order_rate"] <= 1
    lookup = report.metric_value(
        loaded["model_forecast_comparison"], "WAPE (%)", "random_forest_model"
    )
    assert lookup.first()[0] > 0
    assert loaded["retail_cleaned"].storageLevel.useMemory
    loaded.release()
    assert not loaded["retail_cleaned"].storageLevel.useMemory
    with tables.keep_in_memory(tables.read_report_tables(spark, results)) as again:
        kept = again["logistics_cleaned"]
        assert report.latest_shipments(kept).count() == 200
    assert not kept.storageLevel.useMemory


def test_date_filter_prunes_months(spark, results):
    picked = catalog.FILTERS.retail(columns_of(spark, results, "retail_cleaned"))
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
