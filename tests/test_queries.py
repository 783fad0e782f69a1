"""Every registered query against its SQL on the small tables."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from orderflow.models import delay, demand
from orderflow.plans.catalog import QUERIES
from orderflow.plans.oracle import ORACLE as SQL

#: Queries on trained models, which SQL cannot express.
MODEL_KEYS = {
    "k6_top_features",
    "m4_model_comparison",
    "l5_fit_predict",
    "l6_demand_predictions",
    "l7_delay_metrics",
    "l8_delay_risk",
    "l9_demand_importance",
    "l9_delay_importance",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql_except_models():
    assert set(QUERIES) - set(SQL) == MODEL_KEYS
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, con, key):
    assert difference(QUERIES[key](spark, sf_dir), con, SQL[key]) is None


def test_entry_has_rows(spark):
    assert entry(spark).count() == 6


def test_model_queries_cover_whole_tables(spark, sf_dir, con):
    shipments = con.execute("SELECT count(*) FROM orders").fetchone()[0]
    assert QUERIES["l8_delay_risk"](spark, sf_dir).count() == shipments
    tested = con.execute(SQL["l2_stratified_split"]).fetchall()
    assert QUERIES["l5_fit_predict"](spark, sf_dir).count() == len(tested)
    held_out = con.execute(SQL["l1_split"]).fetchall()
    assert QUERIES["l6_demand_predictions"](spark, sf_dir).count() == len(held_out)


def test_importances_sum_to_one_and_are_sorted(spark, sf_dir):
    for key, numeric in (
        ("l9_demand_importance", demand.NUMERIC),
        ("l9_delay_importance", delay.NUMERIC),
    ):
        rows = QUERIES[key](spark, sf_dir).collect()
        weights = [r["importance"] for r in rows]
        assert sum(weights) == pytest.approx(1.0)
        assert weights == sorted(weights, reverse=True)
        assert set(numeric) <= {r["feature"] for r in rows}


def test_feature_names_carry_column_and_value(spark, sf_dir):
    names = {r["feature"] for r in QUERIES["l9_delay_importance"](spark, sf_dir).collect()}
    assert {"traffic_status_Heavy", "asset_id_Truck_10", "waiting_time"} <= names
    assert len(names) == 3 + 10 + 7


def test_model_metrics_follow_from_predictions(spark, sf_dir):
    rows = QUERIES["l5_fit_predict"](spark, sf_dir).collect()
    tp = sum(r.logistics_delay == 1 and r.prediction == 1 for r in rows)
    fp = sum(r.logistics_delay == 0 and r.prediction == 1 for r in rows)
    fn = sum(r.logistics_delay == 1 and r.prediction == 0 for r in rows)
    hits = sum(r.logistics_delay == r.prediction for r in rows)
    got = {r["metric"]: r["value"] for r in QUERIES["l7_delay_metrics"](spark, sf_dir).collect()}
    assert got["Accuracy"] == pytest.approx(hits / len(rows))
    assert got["F1_Score"] == pytest.approx(2 * tp / (2 * tp + fp + fn))


def test_delay_risk_is_a_probability_that_finds_heavy_traffic(spark, sf_dir):
    risk = {r["shipment_id"]: r["delay_risk_score"]
            for r in QUERIES["l8_delay_risk"](spark, sf_dir).collect()}
    assert all(0.0 <= p <= 1.0 for p in risk.values())
    heavy = [p for k, p in risk.items() if k % 3 == 2]
    other = [p for k, p in risk.items() if k % 3 != 2]
    assert sum(heavy) / len(heavy) > sum(other) / len(other)


def test_comparison_agrees_on_mean_volume(spark, sf_dir):
    """MAE over WAPE is the mean actual volume, whatever the forecast."""
    rows = {r["metric"]: r for r in QUERIES["m4_model_comparison"](spark, sf_dir).collect()}
    mae, wape = rows["MAE"], rows["WAPE (%)"]
    ratio = [mae[c] / wape[c] for c in ("naive_moving_avg_baseline", "random_forest_model")]
    assert ratio[0] == pytest.approx(ratio[1])
