"""Tiny literal tables, one per rule on missing values, zeros, ties and rounding."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderflow.functions import metrics
from orderflow.functions.expr import flag
from orderflow.models import forest
from orderflow.operators import bridge, kpis, quality
from orderflow.operators.logistics import clean_logistics
from orderflow.operators.retail import clean_retail, with_row_measures
from orderflow.plans import catalog, report
from orderflow.plans.report import FilterSpec
from orderflow.sources.schemas import LOGISTICS, RETAIL

DAY = dt.date(2022, 1, 3)  # a Monday


def retail(spark, *rows):
    base = {
        "date": DAY,
        "store_id": "S001",
        "product_id": "P0001",
        "category": "Toys",
        "region": "North",
        "inventory_level": 100.0,
        "units_sold": 10.0,
        "units_ordered": 20.0,
        "demand_forecast": 12.0,
        "price": 5.0,
        "discount": 10.0,
        "weather_condition": "Sunny",
        "holiday_promotion": 0,
        "competitor_pricing": 6.0,
        "seasonality": "Winter",
    }
    full = [{**base, **row} for row in rows]
    return spark.createDataFrame([tuple(r[n] for n in RETAIL.names) for r in full], RETAIL)


def logistics(spark, *rows):
    base = {
        "ts": dt.datetime(2024, 3, 5, 17, 45),
        "asset_id": "Truck_1",
        "shipment_status": "Delivered",
        "traffic_status": "Clear",
        "waiting_time": 10.0,
        "asset_utilization": 80.0,
        "logistics_delay": 0,
        "logistics_delay_reason": None,
        "temperature": 20.0,
        "humidity": 60.0,
        "user_transaction_amount": 300.0,
        "user_purchase_frequency": 4.0,
        "inventory_level": 250.0,
    }
    full = [{**base, **row} for row in rows]
    return spark.createDataFrame([tuple(r[n] for n in LOGISTICS.names) for r in full], LOGISTICS)


def first(df):
    return df.collect()[0].asDict()


def test_row_measures(spark):
    row = first(clean_retail(retail(spark, {})))
    assert row["revenue"] == pytest.approx(45.0)
    assert row["forecast_error"] == 2.0
    assert row["forecast_abs_error"] == 2.0
    assert row["forecast_ape"] == pytest.approx(0.2)
    assert (row["stockout_occurred"], row["stockout_risk"]) == (0, 0)
    assert row["days_of_supply"] == pytest.approx(10.0)
    assert row["overstock_flag"] == 0
    assert row["price_gap_vs_competitor"] == -1.0
    assert row["priced_above_competitor"] == 0
    assert (row["year"], row["month"], row["day_of_week"]) == (2022, "2022-01", "Monday")


def test_fifteen_derived_columns(spark):
    assert len(clean_retail(retail(spark, {})).columns) == len(RETAIL.names) + 15


def test_comparison_with_missing_value_gives_zero(spark):
    row = first(with_row_measures(retail(spark, {"inventory_level": None})))
    assert (row["stockout_occurred"], row["stockout_risk"]) == (0, 0)
    assert first(clean_retail(retail(spark, {"inventory_level": None})))["overstock_flag"] == 0
    assert first(clean_logistics(logistics(spark, {"logistics_delay": None})))["on_time_flag"] == 0
    assert first(spark.range(1).select(flag(F.lit(None) > 1).alias("f")))["f"] == 0


def test_zero_sales_have_no_percentage_error_and_no_supply_days(spark):
    row = first(clean_retail(retail(spark, {"units_sold": 0.0})))
    assert row["forecast_ape"] is None
    assert row["days_of_supply"] is None
    assert row["overstock_flag"] == 0


def test_stockout_at_equal_stock(spark):
    row = first(with_row_measures(retail(spark, {"units_sold": 12.0, "inventory_level": 12.0})))
    assert (row["stockout_occurred"], row["stockout_risk"]) == (1, 0)


def test_overstock_needs_more_than_thirty_days(spark):
    for stock, expected in ((300.0, 0), (301.0, 1)):
        assert first(clean_retail(retail(spark, {"inventory_level": stock})))[
            "overstock_flag"
        ] == expected


def test_baseline_is_filled_with_the_mean_over_all_rows(spark):
    rows = clean_retail(
        retail(
            spark,
            {"units_sold": 10.0},
            {"units_sold": 20.0, "date": DAY + dt.timedelta(1)},
            {"units_sold": 60.0, "store_id": "S002"},
        )
    ).orderBy("store_id", "date")
    assert [r["naive_ma7_forecast"] for r in rows.collect()] == [30.0, 10.0, 30.0]


def test_groups_without_key_are_left_out(spark):
    rows = with_row_measures(retail(spark, {}, {"category": None}, {"region": None}))
    assert kpis.units_by_promo(rows).count() == 1
    assert report.revenue_by_category(rows).count() == 1
    full = clean_retail(retail(spark, {}, {"category": None}, {"region": None}))
    assert kpis.retail_kpi_daily(full).count() == 1
    trucks = clean_logistics(logistics(spark, {}, {"asset_id": None}))
    assert kpis.logistics_asset_kpi(trucks).count() == 1


def test_sum_over_missing_values_is_zero_and_mean_is_missing(spark):
    row = first(
        kpis.retail_kpi_daily(
            clean_retail(retail(spark, {"units_sold": None, "inventory_level": None}))
        )
    )
    assert (row["units_sold"], row["revenue"]) == (0.0, 0.0)
    assert row["avg_inventory"] is None


def test_monthly_error_share_without_volume_is_missing(spark):
    row = first(kpis.retail_monthly_overall(clean_retail(retail(spark, {"units_sold": 0.0}))))
    assert row["forecast_wape_pct"] is None


def test_promo_lift(spark):
    rows = retail(
        spark,
        {"units_sold": 10.0},
        {"units_sold": 15.0, "holiday_promotion": 1},
        {"category": "Food", "units_sold": 0.0},
        {"category": "Food", "units_sold": 5.0, "holiday_promotion": 1},
        {"category": "Solo", "units_sold": 5.0},
        {"category": "Gone", "holiday_promotion": None},
    )
    got = {r["category"]: r.asDict() for r in kpis.retail_promo_lift(rows).collect()}
    assert got["Toys"]["promo_lift_pct"] == pytest.approx(50.0)
    assert got["Food"]["promo_lift_pct"] is None  # nothing sold without promotion
    assert got["Solo"]["avg_units_with_promo"] is None
    assert "Gone" not in got


def rounded_rows(df):
    return sorted(
        tuple(round(v, 4) if isinstance(v, float) else v for v in row) for row in df.collect()
    )


@pytest.mark.parametrize(
    "build",
    [
        kpis.retail_kpi_daily,
        kpis.retail_kpi_monthly,
        kpis.retail_monthly_overall,
        kpis.retail_category_summary,
        kpis.retail_promo_lift,
    ],
)
def test_retail_tables_from_totals_equal_tables_from_rows(spark, sf_dir, build):
    rows = catalog.retail_cleaned(spark, sf_dir)
    assert rounded_rows(build(kpis.retail_totals(rows))) == rounded_rows(build(rows))


def test_retail_totals_keep_gaps_apart(spark):
    rows = clean_retail(
        retail(
            spark,
            {"inventory_level": None},
            {"inventory_level": 40.0, "holiday_promotion": None},
            {"inventory_level": 60.0, "holiday_promotion": 1},
            {"units_sold": None, "category": "Food", "inventory_level": None},
            {"region": None, "holiday_promotion": 1},
        ),
        ["units_sold"],
    )
    totals = kpis.retail_totals(rows)
    for build in (kpis.retail_kpi_daily, kpis.retail_monthly_overall, kpis.units_by_promo):
        assert [
            tuple(r) for r in build(totals).orderBy(build(totals).columns[-1]).collect()
        ] == [tuple(r) for r in build(rows).orderBy(build(rows).columns[-1]).collect()]


@pytest.mark.parametrize(
    "build",
    [
        kpis.logistics_asset_kpi,
        kpis.logistics_traffic_kpi,
        kpis.logistics_monthly_otd,
        kpis.logistics_delay_reason_kpi,
    ],
)
def test_logistics_tables_from_totals_equal_tables_from_rows(spark, sf_dir, build):
    rows = catalog.shipments(spark, sf_dir)
    assert rounded_rows(build(kpis.logistics_totals(rows))) == rounded_rows(build(rows))


def test_missing_delay_reason_is_a_reason(spark):
    log = clean_logistics(
        logistics(
            spark,
            {"logistics_delay": 1},
            {"logistics_delay": 1, "logistics_delay_reason": "Weather"},
            {"logistics_delay": 1, "logistics_delay_reason": "Weather"},
            {"logistics_delay": 0, "logistics_delay_reason": "Traffic"},
        )
    )
    rows = kpis.logistics_delay_reason_kpi(log).collect()
    assert [tuple(r) for r in rows] == [("Weather", 66.7), ("None", 33.3)]


def test_share_is_rounded_to_the_even_digit(spark):
    """1 of 16 is 6.25 percent, 3 of 16 is 18.75."""
    reasons = ["A"] * 1 + ["B"] * 3 + ["C"] * 12
    log = clean_logistics(
        logistics(spark, *[{"logistics_delay": 1, "logistics_delay_reason": r} for r in reasons])
    )
    got = {r[0]: r[1] for r in kpis.logistics_delay_reason_kpi(log).collect()}
    assert got == {"A": 6.2, "B": 18.8, "C": 75.0}


def test_shipment_columns(spark):
    row = first(clean_logistics(logistics(spark, {"shipment_status": "Delayed"})))
    assert (row["on_time_flag"], row["delivered_flag"]) == (1, 0)
    assert row["date"] == dt.date(2024, 3, 5)
    assert (row["month"], row["hour"]) == ("2024-03", 17)


def test_mode_takes_the_smallest_of_tied_values(spark):
    rows = with_row_measures(
        retail(
            spark,
            {"category": "Toys", "region": "West"},
            {"category": "Food", "region": "West"},
            {"category": "Food", "region": "East"},
            {"category": "Toys", "region": None},
        )
    )
    row = first(bridge.replenishment_events(rows))
    assert (row["category"], row["region"]) == ("Food", "West")


def test_perfect_order_needs_stock_and_punctuality(spark):
    rows = with_row_measures(
        retail(
            spark,
            {"product_id": "in stock"},
            {"product_id": "sold out", "inventory_level": 1.0},
        )
    )
    for delay, expected in ((0, {"in stock": 1, "sold out": 0}), (1, {"in stock": 0, "sold out": 0})):
        log = clean_logistics(logistics(spark, {"logistics_delay": delay})).withColumn(
            "shipment_id", F.lit(7).cast("bigint")
        )
        pairs = bridge.build_bridge(rows, log)
        assert {r["product_id"]: r["perfect_order"] for r in pairs.collect()} == expected


def test_bridge_of_no_shipments_is_empty(spark):
    log = clean_logistics(logistics(spark, {})).withColumn("shipment_id", F.lit(1).cast("bigint"))
    rows = with_row_measures(retail(spark, {}))
    assert bridge.build_bridge(rows, log.where("false")).count() == 0


def test_optional_shipment_columns(spark):
    log = clean_logistics(logistics(spark, {})).withColumn("shipment_id", F.lit(1).cast("bigint"))
    rows = with_row_measures(retail(spark, {}))
    assert "delay_risk_score" not in bridge.build_bridge(rows, log).columns
    scored = log.withColumn("delay_risk_score", F.lit(0.5))
    assert "delay_risk_score" in bridge.build_bridge(rows, scored).columns


def test_wape_and_f1_without_volume(spark):
    zero = spark.createDataFrame([(0.0, 1.0)], "a double, f double")
    assert first(zero.select(metrics.wape(F.col("a"), F.col("f")).alias("w")))["w"] is None
    quiet = spark.createDataFrame([(0, 0)], "y int, p int")
    assert first(quiet.select(metrics.f1_positive(F.col("y"), F.col("p")).alias("f")))["f"] == 0.0


def test_unseen_and_missing_category_are_all_zero(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    train = spark.createDataFrame([("b",), ("a",), ("c",)], "v string")
    model = Pipeline(stages=forest.one_hot_stages(["v"])).fit(train)
    rows = spark.createDataFrame([("a",), ("c",), ("z",), (None,)], "v string")
    got = model.transform(rows).select("v", vector_to_array("v_onehot").alias("x")).collect()
    assert [r["x"] for r in got] == [[1, 0, 0], [0, 0, 1], [0, 0, 0], [0, 0, 0]]


def test_missing_number_is_not_trained_on_silently(spark):
    rows = spark.createDataFrame([("a", None), ("b", 2.0)], "v string, x double")
    with pytest.raises(Exception, match="handleInvalid"):
        forest.assembler([], ["x"]).transform(rows).collect()


def test_attribute_stability_counts_values(spark):
    rows = retail(spark, {}, {"category": "Food"}, {"region": "East"})
    row = first(quality.attribute_stability(rows))
    assert (row["categories"], row["regions"]) == (2, 2)


def test_filter_scope(spark):
    spec = FilterSpec(
        regions=["North"], categories=["Toys"], start=DAY, end=DAY, trucks=["Truck_1"]
    )
    rows = with_row_measures(
        retail(
            spark,
            {},
            {"region": "South"},
            {"category": "Food"},
            {"date": DAY + dt.timedelta(1)},
            {"date": DAY - dt.timedelta(1)},
        )
    )
    assert spec.retail(rows).count() == 1
    log = clean_logistics(logistics(spark, {}, {"asset_id": "Truck_2"}))
    assert spec.logistics(log).count() == 1
    pairs = rows.select("category", "region")
    assert spec.by_category(pairs).count() == 4  # region and dates do not reach the bridge
    everything = FilterSpec()
    assert everything.retail(rows).count() == 5
    assert FilterSpec(regions=[]).retail(rows).count() == 0
    assert report.nothing_selected(rows.where("false"), log)
    assert not report.nothing_selected(rows, log)


def test_latest_shipments_limit_and_order(spark):
    base = dt.datetime(2024, 1, 1)
    log = clean_logistics(
        logistics(spark, *[{"ts": base + dt.timedelta(hours=i)} for i in range(30)])
    ).withColumn("shipment_id", F.monotonically_increasing_id())
    got = [r["ts"] for r in report.latest_shipments(log, rows=5).collect()]
    assert got == [base + dt.timedelta(hours=29 - i) for i in range(5)]


def test_a_long_list_of_choices_is_a_join(spark):
    rows = spark.createDataFrame([(f"r{i}", i) for i in range(500)], "region string, date int")
    picked = report.FilterSpec(regions=[f"r{i}" for i in range(0, 600, 2)] + ["r0"]).retail(rows)
    assert picked.columns == rows.columns
    assert sorted(r["date"] for r in picked.collect()) == list(range(0, 500, 2))
    plan = picked._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
