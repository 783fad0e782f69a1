"""All panels of a selection from one pass, against the single panels; modes of events."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderflow.operators import bridge
from orderflow.plans import report
from orderflow.plans.report import Dashboard, FilterSpec
from orderflow.session import stage


@pytest.fixture(scope="module")
def stored(spark):
    """Three small tables with missing keys and measures, as files."""
    day = dt.date(2022, 1, 30)
    retail = [(day + dt.timedelta(days=i % 5), ["2022-01", "2022-02"][i % 5 > 1], [None, "N", "S"][i % 3],
               [None, "Toys", "Food", "Toys"][i % 4], float(i), None if i % 6 == 0 else float(i % 9), i % 7 % 2)
              for i in range(60)]
    logistics = [([None, "T1", "T2"][i % 3], [None, "Clear", "Heavy"][i % 5 % 3], ["2022-01", None][i % 2],
                  i % 2, [None, "None", "Weather"][i % 7 % 3], 1 - i % 2, float(i)) for i in range(70)]
    pairs = [(["Toys", "Food", None][i % 3], i % 4 // 3, i % 2, i % 2 * (i % 4 != 3)) for i in range(40)]
    return (
        stage(spark.createDataFrame(retail, "date date, month string, region string, category string, "
                                    "revenue double, units_sold double, stockout_occurred int"), "r"),
        stage(spark.createDataFrame(logistics, "asset_id string, traffic_status string, month string, "
                                    "logistics_delay int, logistics_delay_reason string, on_time_flag int, "
                                    "waiting_time double"), "l"),
        stage(spark.createDataFrame(pairs, "category string, stockout_occurred int, delivered_on_time int, "
                                    "perfect_order int"), "b"),
    )


PICKS = [
    FilterSpec(),
    FilterSpec(regions=["N"], categories=["Toys"], start=dt.date(2022, 1, 31), trucks=["T2"]),
    FilterSpec(regions=["nowhere"], categories=["nothing"], trucks=["none"]),
]


def plain(df):
    return df.columns, [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("pick", PICKS)
def test_panels_of_one_pass_equal_single_panels(stored, pick):
    retail, logistics, pairs = stored
    r, s, b = pick.retail(retail), pick.logistics(logistics), pick.by_category(pairs)
    board = Dashboard.of(pick, retail, logistics, pairs)
    assert plain(board.cards()) == plain(report.kpi_cards(r, s, b))
    assert plain(board.rate_components()) == plain(report.rate_components(b))
    for own, single in (
        (board.revenue_by_category(), report.revenue_by_category(r)),
        (board.monthly_revenue(), report.monthly_revenue(r)),
        (board.truck_table(), report.truck_table(s)),
        (board.monthly_on_time(), report.monthly_on_time(s)),
        (board.delay_causes(), report.delay_causes(s)),
    ):
        assert plain(own) == plain(single)
    for own, single in (
        (board.stockout_by_category(), report.stockout_by_category(r)),
        (board.on_time_by_traffic(), report.on_time_by_traffic(s)),
    ):
        assert sorted(map(repr, plain(own)[1])) == sorted(map(repr, plain(single)[1]))


def test_rows_are_read_once_with_filters_pushed(stored):
    pick = FilterSpec(regions=["N"])
    rows = report._panel_rows(pick.retail(stored[0]), report.RETAIL_PANELS, [F.sum("revenue").alias("x")])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PushedFilters: [IsNotNull(region), EqualTo(region,N)]" in plan


def test_a_panel_of_a_dashboard_reads_only_the_panel_rows(stored):
    board = Dashboard.of(FilterSpec(), *stored)
    rows = {f for t in stored for f in t.inputFiles()}
    for panel in (board.cards(), board.truck_table(), board.delay_causes(), board.rate_components()):
        plan = panel._jdf.queryExecution().executedPlan().toString()
        assert "panels-" in plan
        assert not rows & set(panel.inputFiles())


def test_modes_without_object_aggregates(spark):
    rows = [("2022-01", "S1", "P1", c, r, 1.0, 0, 0, a) for c, r, a in (
        ("b", "N", 0.5), ("a", "S", None), ("b", "S", 0.25), ("a", None, 0.0), (None, "W", 1.0), (None, "W", None), (None, "W", 0.5))]
    rows += [("2022-01", "S1", "P2", None, None, None, 1, 1, None), ("2022-02", "S1", "P1", "z", "E", 2.0, 1, 0, 3.0)]
    table = stage(spark.createDataFrame(
        rows, "month string, store_id string, product_id string, category string, region string, "
              "units_ordered double, stockout_occurred int, stockout_risk int, forecast_ape double"), "modes")
    events = bridge.replenishment_events(table)
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and plan.count("FileScan") == 1
    got = {tuple(r)[:3]: tuple(r)[3:] for r in events.collect()}
    assert got == {
        ("2022-01", "S1", "P1"): ("a", "W", 7.0, 0, 0, pytest.approx(0.45)),
        ("2022-01", "S1", "P2"): (None, None, 0.0, 1, 1, None),
        ("2022-02", "S1", "P1"): ("z", "E", 2.0, 1, 0, 3.0),
    }
