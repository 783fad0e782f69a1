"""The catalog queries as ANSI SQL over the same Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from orderflow.models import delay, demand
from orderflow.plans import tree_sql

RETAIL = """retail AS (
  SELECT cast(l.l_shipdate AS date) AS date,
    concat('S00', sn.n_regionkey + 1) AS store_id,
    p.p_brand AS product_id, p.p_type AS category, r.r_name AS region,
    CASE WHEN l.l_orderkey % 101 = 0 THEN NULL
         ELSE cast(20 + p.p_size AS double) END AS inventory_level,
    CASE WHEN l.l_orderkey % 97 = 0 THEN 0e0 ELSE l.l_quantity END AS units_sold,
    l.l_quantity + l.l_linenumber AS units_ordered,
    l.l_quantity * (96e-2 + l.l_tax) AS demand_forecast,
    l.l_extendedprice / l.l_quantity AS price,
    l.l_discount * 1e2 AS discount,
    CASE l.l_returnflag WHEN 'A' THEN 'Sunny' WHEN 'N' THEN 'Rainy'
         WHEN 'R' THEN 'Cloudy' END AS weather_condition,
    CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS holiday_promotion,
    p.p_retailprice * 125e-2 AS competitor_pricing,
    CASE WHEN month(l.l_shipdate) IN (12, 1, 2) THEN 'Winter'
         WHEN month(l.l_shipdate) BETWEEN 3 AND 5 THEN 'Spring'
         WHEN month(l.l_shipdate) BETWEEN 6 AND 8 THEN 'Summer'
         ELSE 'Autumn' END AS seasonality,
    l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN region r ON cn.n_regionkey = r.r_regionkey)"""

LOGISTICS = """logistics AS (
  SELECT o_orderkey AS shipment_id,
    o_orderdate + to_hours(cast(o_orderkey % 24 AS int)) AS ts,
    concat('Truck_', o_custkey % 10 + 1) AS asset_id,
    CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'In Transit'
         ELSE 'Delayed' END AS shipment_status,
    CASE o_orderkey % 3 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Detour' ELSE 'Heavy' END
      AS traffic_status,
    cast(o_orderkey % 61 AS double) AS waiting_time,
    60e0 + o_custkey % 41 AS asset_utilization,
    CASE WHEN o_orderkey % 3 = 2 OR (o_orderkey * 7 + o_custkey) % 100 < 35
         THEN 1 ELSE 0 END AS logistics_delay,
    CASE o_custkey % 4 WHEN 1 THEN 'Weather' WHEN 2 THEN 'Traffic'
         WHEN 3 THEN 'Mechanical Failure' END AS logistics_delay_reason,
    18e0 + (o_orderkey % 130) / 1e1 AS temperature,
    50e0 + (o_orderkey % 300) / 1e1 AS humidity,
    o_totalprice / 1e3 AS user_transaction_amount,
    1e0 + o_custkey % 10 AS user_purchase_frequency,
    100e0 + o_orderkey % 401 AS inventory_level
  FROM orders)"""

ROWS = """rows_ AS (
  SELECT *,
    units_sold * price * (1 - discount / 100) AS revenue,
    demand_forecast - units_sold AS forecast_error,
    abs(demand_forecast - units_sold) AS forecast_abs_error,
    CASE WHEN units_sold > 0 THEN abs(demand_forecast - units_sold) / units_sold END
      AS forecast_ape,
    CASE WHEN units_sold >= inventory_level THEN 1 ELSE 0 END AS stockout_occurred,
    CASE WHEN demand_forecast > inventory_level THEN 1 ELSE 0 END AS stockout_risk,
    price - competitor_pricing AS price_gap_vs_competitor,
    CASE WHEN price - competitor_pricing > 0 THEN 1 ELSE 0 END AS priced_above_competitor,
    cast(year(date) AS int) AS year,
    strftime(date, '%Y-%m') AS month,
    dayname(date) AS day_of_week
  FROM retail)"""

SERIES = """means AS (
  SELECT *,
    avg(units_sold) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS avg_daily_sales_7d,
    coalesce(avg(units_sold) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
             (SELECT avg(units_sold) FROM retail)) AS naive_ma7_forecast
  FROM rows_
  WINDOW w AS (PARTITION BY store_id, product_id
               ORDER BY date, l_orderkey, l_linenumber, l_partkey, l_suppkey)),
cleaned AS (
  SELECT *,
    CASE WHEN avg_daily_sales_7d > 0 THEN inventory_level / avg_daily_sales_7d END
      AS days_of_supply,
    CASE WHEN avg_daily_sales_7d > 0 AND inventory_level / avg_daily_sales_7d > 30
         THEN 1 ELSE 0 END AS overstock_flag
  FROM means)"""

SHIPMENTS = """shipments AS (
  SELECT * REPLACE (coalesce(logistics_delay_reason, 'None') AS logistics_delay_reason),
    CASE WHEN logistics_delay = 0 THEN 1 ELSE 0 END AS on_time_flag,
    CASE WHEN shipment_status = 'Delivered' THEN 1 ELSE 0 END AS delivered_flag,
    cast(ts AS date) AS date,
    strftime(ts, '%Y-%m') AS month,
    cast(hour(ts) AS int) AS hour,
    (shipment_id * 37 % 1000) / 1e3 AS delay_risk_score
  FROM logistics)"""


def hashed(*parts: str) -> str:
    text = ", ".join(["'42'", *parts])
    return f"cast('0x' || substr(md5(concat_ws('|', {text})), 1, 15) AS bigint)"


def mode_of(column: str) -> str:
    return f"""(SELECT month, store_id, product_id, {column} FROM (
    SELECT month, store_id, product_id, {column},
      row_number() OVER (PARTITION BY month, store_id, product_id
                         ORDER BY count(*) DESC, {column}) AS rank_
    FROM rows_ WHERE {column} IS NOT NULL GROUP BY month, store_id, product_id, {column})
  WHERE rank_ = 1)"""


EVENTS = f"""events_ AS (
  SELECT g.month, g.store_id, g.product_id, mc.category, mr.region, g.units_ordered,
    g.stockout_occurred, g.stockout_risk, g.forecast_ape
  FROM (SELECT month, store_id, product_id, sum(units_ordered) AS units_ordered,
          max(stockout_occurred) AS stockout_occurred, max(stockout_risk) AS stockout_risk,
          avg(forecast_ape) AS forecast_ape
        FROM rows_ GROUP BY month, store_id, product_id) g
  JOIN {mode_of("category")} mc USING (month, store_id, product_id)
  JOIN {mode_of("region")} mr USING (month, store_id, product_id))"""

BRIDGE = f"""numbered AS (
  SELECT *, row_number() OVER (ORDER BY {hashed("shipment_id")}, shipment_id) - 1 AS draw
  FROM shipments),
bridge AS (
  SELECT e.*, s.shipment_id, s.asset_id, s.shipment_status, s.traffic_status, s.waiting_time,
    s.logistics_delay, s.logistics_delay_reason, s.on_time_flag AS delivered_on_time,
    s.delay_risk_score,
    CASE WHEN e.stockout_occurred = 0 AND s.on_time_flag = 1 THEN 1 ELSE 0 END AS perfect_order
  FROM events_ e JOIN numbered s
    ON s.draw = {hashed("e.month", "e.store_id", "e.product_id")}
                % (SELECT count(*) FROM shipments))"""

KEY = "store_id, product_id, date, l_orderkey, l_linenumber, l_partkey, l_suppkey"
HELD_OUT = f"held_out AS (SELECT * FROM cleaned WHERE {hashed(*KEY.split(', '))} % 10000 < 2000)"
#: Test shipments: of every label the first fifth in the order of hashed keys.
TESTED = f"""tested AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY logistics_delay
        ORDER BY {hashed("logistics_delay", "shipment_id")}, shipment_id) AS number_,
      count(*) OVER (PARTITION BY logistics_delay) AS labelled FROM shipments)
  WHERE number_ <= floor(labelled * 0.2 + 0.5))"""
RULE = f"""{TESTED},
rule_ AS (
  SELECT *, CASE WHEN traffic_status = 'Heavy' THEN 1 ELSE 0 END AS prediction FROM tested)"""

IN_CATEGORY = "category IN ('ECONOMY', 'PROMO', 'SMALL')"
PICKED_RETAIL = f"""region IN ('ASIA', 'EUROPE') AND {IN_CATEGORY}
  AND date BETWEEN DATE '1996-03-15' AND DATE '1999-09-30'"""
PICKED_TRUCKS = "asset_id IN ('Truck_1', 'Truck_3', 'Truck_8')"

_ON_RETAIL = (RETAIL,)
_ON_ROWS = (RETAIL, ROWS)
_ON_CLEANED = (RETAIL, ROWS, SERIES)
_ON_LOGISTICS = (LOGISTICS,)
_ON_SHIPMENTS = (LOGISTICS, SHIPMENTS)
_ON_EVENTS = (RETAIL, ROWS, EVENTS)
_ON_BRIDGE = (RETAIL, ROWS, EVENTS, LOGISTICS, SHIPMENTS, BRIDGE)
_ON_BOTH = (RETAIL, ROWS, LOGISTICS, SHIPMENTS)
_ON_HELD_OUT = (*_ON_CLEANED, HELD_OUT)
_ON_RULE = (LOGISTICS, SHIPMENTS, RULE)

_TREE_NUMERIC = tuple(c for c in demand.NUMERIC if c != "price")


def _on_demand_tree(depth: int) -> tuple[str, ...]:
    return (
        *_ON_CLEANED,
        "dated AS (SELECT *, month(date) AS month_num FROM cleaned)",
        tree_sql.tree_tables(
            "dated", KEY, demand.TARGET, f"{hashed(*KEY.split(', '))} % 10000 >= 2000",
            demand.CATEGORICAL, _TREE_NUMERIC, depth, "variance"),
    )


def _on_delay_tree(depth: int) -> tuple[str, ...]:
    return (
        *_ON_SHIPMENTS,
        TESTED,
        tree_sql.tree_tables(
            "shipments", "shipment_id", delay.TARGET,
            "shipment_id NOT IN (SELECT shipment_id FROM tested)",
            delay.CATEGORICAL, delay.NUMERIC, depth, "gini"),
    )


_ON_DEMAND_TREE, _ON_DELAY_TREE = _on_demand_tree(2), _on_delay_tree(2)


# Rates often end exactly on half a unit of the sixth digit, and the last bit of a sum
# depends on its order. The nudge before rounding, on both sides, decides such ties.


def sql(tables: tuple[str, ...], query: str) -> str:
    return "WITH " + ",\n".join(tables) + "\n" + query


def retail_column(name: str, tables: tuple[str, ...] = _ON_ROWS, source: str = "rows_") -> str:
    return sql(tables, f"SELECT {KEY}, {name} FROM {source}")


def series_column(name: str) -> str:
    return retail_column(name, _ON_CLEANED, "cleaned")


def shipment_column(name: str) -> str:
    return sql(_ON_SHIPMENTS, f"SELECT shipment_id, {name} FROM shipments")


def mean(column: str, name: str) -> str:
    return f"round(avg({column}) + 1e-9, 6) AS {name}"


def money(name: str = "revenue") -> str:
    return f"round(coalesce(sum(revenue), 0e0), 4) AS {name}"


def units(column: str = "units_sold", name: str | None = None) -> str:
    return f"round(coalesce(sum({column}), 0e0) + 1e-9, 6) AS {name or column}"


def wape(forecast: str, actual: str = "units_sold") -> str:
    return f"sum(abs({actual} - {forecast})) / nullif(sum({actual}), 0) * 1e2"


SUMMARY = f"""SELECT category, {money("total_revenue")}, {units(name="total_units_sold")},
  {mean("forecast_ape", "forecast_mape")}, {mean("stockout_occurred", "stockout_rate")},
  {mean("overstock_flag", "overstock_rate")}, {mean("days_of_supply", "avg_days_of_supply")}
FROM cleaned WHERE category IS NOT NULL"""

PROMO = """SELECT category,
    avg(CASE WHEN holiday_promotion = 0 THEN units_sold END) AS a,
    avg(CASE WHEN holiday_promotion = 1 THEN units_sold END) AS b
  FROM retail WHERE category IS NOT NULL GROUP BY category"""
PROMO_LIFT = f"""SELECT category, round(a + 1e-9, 6) AS avg_units_no_promo,
  round(b + 1e-9, 6) AS avg_units_with_promo, round((b - a) / nullif(a, 0) * 1e2 + 1e-9, 6) AS promo_lift_pct
FROM ({PROMO})"""

ASSETS = f"""SELECT asset_id, count(*) AS shipments, {mean("on_time_flag", "on_time_rate")},
  {mean("waiting_time", "avg_waiting_time")},
  {mean("asset_utilization", "avg_asset_utilization")},
  {mean("delivered_flag", "delivered_rate")}
FROM shipments GROUP BY asset_id"""

TRUCKS = f"""SELECT asset_id, count(*) AS shipments, {mean("on_time_flag", "on_time_rate")},
  {mean("waiting_time", "avg_waiting_time")} FROM shipments"""

MONTHLY_OTD = f"""SELECT month, count(*) AS shipments, {mean("on_time_flag", "on_time_rate")},
  {mean("waiting_time", "avg_waiting_time")} FROM shipments GROUP BY month"""

PERFECT = """SELECT category, count(*) AS replenishment_events,
  round(avg(perfect_order) * 1e2 + 1e-9, 6) AS perfect_order_rate,
  round((1 - avg(stockout_occurred)) * 1e2 + 1e-9, 6) AS stockout_free_rate,
  round(avg(delivered_on_time) * 1e2 + 1e-9, 6) AS on_time_rate
FROM bridge WHERE category IS NOT NULL"""


def causes(name: str, rounding: str, where: str = "") -> str:
    condition = f"logistics_delay = 1{' AND ' + where if where else ''}"
    everything = f"(SELECT count(*) FROM shipments WHERE {condition})"
    share = f"cast(count(*) AS double) / {everything} * 1e2"
    return sql(
        _ON_SHIPMENTS,
        f"""SELECT logistics_delay_reason AS delay_reason, {rounding.format(share)} AS {name}
FROM shipments WHERE {condition} GROUP BY logistics_delay_reason""",
    )


def sizes(named: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, {count} AS n" for name, count in named.items()
    )


def rows_in(query: str) -> str:
    return f"(SELECT count(*) FROM {query})"


def groups(keys: str, source: str) -> str:
    return rows_in(f"(SELECT DISTINCT {keys} FROM {source})")


_DEMAND_SLOTS = " + ".join(
    groups(c, "rows_")
    for c in (
        "store_id",
        "product_id",
        "category",
        "region",
        "weather_condition",
        "seasonality",
        "day_of_week",
    )
)
_TABLE_SIZES = {
    "retail_cleaned": rows_in("rows_"),
    "logistics_cleaned": rows_in("shipments"),
    "retail_kpi_daily": groups("date, region, category", "rows_"),
    "retail_kpi_monthly": groups("month, region, category", "rows_"),
    "retail_monthly_overall": groups("month", "rows_"),
    "retail_category_summary": groups("category", "rows_"),
    "retail_promo_lift": groups("category", "rows_"),
    "logistics_asset_kpi": groups("asset_id", "shipments"),
    "logistics_traffic_kpi": groups("traffic_status", "shipments"),
    "logistics_delay_reason_kpi": rows_in(
        "(SELECT DISTINCT logistics_delay_reason FROM shipments WHERE logistics_delay = 1)"
    ),
    "logistics_monthly_otd": groups("month", "shipments"),
    "model_forecast_comparison": "2",
    "model_forecast_feature_importance": f"5 + {_DEMAND_SLOTS}",
    "model_delay_metrics": "2",
    "model_delay_feature_importance": (
        f"7 + {groups('traffic_status', 'shipments')} + {groups('asset_id', 'shipments')}"
    ),
    "bridge_perfect_order": rows_in("bridge"),
    "perfect_order_by_category": groups("category", "bridge"),
}
_REPORT_SIZES = {
    k: v for k, v in _TABLE_SIZES.items() if k not in ("retail_kpi_daily", "retail_kpi_monthly")
}

_CONFUSION = """count(*) FILTER (WHERE logistics_delay = 1 AND prediction = 1) AS tp,
    count(*) FILTER (WHERE logistics_delay = 0 AND prediction = 1) AS fp,
    count(*) FILTER (WHERE logistics_delay = 1 AND prediction = 0) AS fn,
    avg(CASE WHEN logistics_delay = prediction THEN 1 ELSE 0 END) AS acc"""
_F1 = "round(2e0 * tp / (2 * tp + fp + fn) + 1e-9, 6)"

STORED_BRIDGE = """month, store_id, product_id, category, region,
  round(units_ordered + 1e-9, 6) AS units_ordered, stockout_occurred, stockout_risk,
  round(forecast_ape + 1e-9, 6) AS forecast_ape, shipment_id, asset_id, shipment_status,
  traffic_status, round(waiting_time + 1e-9, 6) AS waiting_time, logistics_delay,
  logistics_delay_reason, delivered_on_time, perfect_order"""
BRIDGE_COLUMNS = f"{STORED_BRIDGE}, round(delay_risk_score + 1e-9, 6) AS delay_risk_score"

DETAIL = """shipment_id, ts, asset_id, shipment_status, traffic_status, waiting_time,
  logistics_delay, logistics_delay_reason, delay_risk_score"""

_STORED_DOUBLES = ", ".join(
    f"round({c} + 1e-9, 6) AS {c}"
    for c in (
        "forecast_error", "forecast_abs_error", "forecast_ape", "price_gap_vs_competitor",
        "avg_daily_sales_7d", "naive_ma7_forecast", "days_of_supply",
    )
)


def _feature_names(table: str, categorical: Sequence[str], numeric: Sequence[str]) -> str:
    """Importance checks: every value of a category and every number is a feature."""
    parts = [f"SELECT DISTINCT '{c}_' || {c} AS feature FROM {table}" for c in categorical]
    parts += [f"SELECT '{c}' AS feature" for c in numeric]
    return f"SELECT feature, 1e0 AS total FROM ({' UNION ALL '.join(parts)})"


ORACLE: dict[str, str] = {
    "a1_retail_csv_round_trip": sql(_ON_RETAIL, "SELECT * FROM retail"),
    "a2_logistics_csv_round_trip": sql(_ON_LOGISTICS, "SELECT * FROM logistics"),
    "a3_header_normalisation": sql(
        _ON_RETAIL,
        f"""SELECT store_id, product_id, count(*) AS n, {units()},
  {mean("holiday_promotion", "promo_share")} FROM retail GROUP BY store_id, product_id""",
    ),
    "a4_parse_dates": sql(
        _ON_LOGISTICS, "SELECT shipment_id, ts, cast(ts AS date) AS date FROM logistics"
    ),
    "a5_sink_csv_export": sql(
        _ON_SHIPMENTS,
        f"""SELECT asset_id AS "Asset_ID", shipments AS "Shipments",
  on_time_rate AS "On_Time_Rate", avg_waiting_time AS "Avg_Waiting_Time",
  avg_asset_utilization AS "Avg_Asset_Utilization", delivered_rate AS "Delivered_Rate"
FROM ({ASSETS})""",
    ),
    "a6_report_tables": sql(_ON_BRIDGE, sizes(_REPORT_SIZES)),
    "a5_sink_small_table": sql(
        _ON_RETAIL,
        f"""SELECT category AS "Category", avg_units_no_promo AS "Avg_Units_No_Promo",
  avg_units_with_promo AS "Avg_Units_With_Promo", promo_lift_pct AS "Promo_Lift_Pct"
FROM ({PROMO_LIFT})""",
    ),
    "a7_cached_tables": sql(
        _ON_BOTH,
        f"""SELECT traffic_status AS grp, {mean("on_time_flag", "on_time_rate")}, 'on time' AS panel
FROM shipments GROUP BY traffic_status
UNION ALL SELECT asset_id AS grp, {mean("on_time_flag", "on_time_rate")}, 'on time' AS panel
FROM shipments GROUP BY asset_id
UNION ALL SELECT category AS grp, {mean("stockout_occurred", "on_time_rate")}, 'stockout' AS panel
FROM rows_ GROUP BY category""",
    ),
    "a8_retail_cleaned": sql(
        _ON_CLEANED,
        f"""SELECT {KEY}, round(revenue, 4) AS revenue, {_STORED_DOUBLES}, stockout_occurred,
  stockout_risk, priced_above_competitor, year, month, day_of_week, overstock_flag FROM cleaned""",
    ),
    "a8_logistics_cleaned": shipment_column(
        "logistics_delay_reason, on_time_flag, delivered_flag, date, month, hour"
    ),
    "a8_bridge_perfect_order": sql(_ON_BRIDGE, f"SELECT {STORED_BRIDGE} FROM bridge"),
    "a8_bridge_with_risk": sql(
        _ON_BRIDGE, "SELECT month, store_id, product_id, shipment_id FROM bridge"
    ),
    "l6_demand_check": sql(
        _ON_HELD_OUT, "SELECT count(*) AS predicted, 0::BIGINT AS outside FROM held_out"
    ),
    "l5_tree_predictions": sql(
        _ON_DELAY_TREE,
        """SELECT shipment_id, cast(y AS int) AS logistics_delay, prediction
FROM ends JOIN based USING (rid) WHERE NOT trained""",
    ),
    "l6_stump_nodes": sql(_on_demand_tree(1), tree_sql.NODES),
    "l7_stump_nodes": sql(_on_delay_tree(1), tree_sql.NODES),
    "l6_tree_nodes": sql(_ON_DEMAND_TREE, tree_sql.NODES),
    "l6_tree_predictions": sql(
        _ON_DEMAND_TREE,
        f"""SELECT {KEY}, y AS units_sold, round(prediction + 1e-9, 6) AS prediction
FROM ends JOIN based USING (rid) WHERE NOT trained""",
    ),
    "l7_tree_nodes": sql(_ON_DELAY_TREE, tree_sql.NODES),
    "l8_tree_risk": sql(
        _ON_DELAY_TREE,
        "SELECT shipment_id, round(share + 1e-9, 6) AS delay_risk_score FROM ends JOIN based USING (rid)",
    ),
    "l9_tree_importance": sql(
        _ON_DELAY_TREE,
        f"""SELECT feature, round(importance + 1e-9, 6) AS importance, 0e0 AS gap
FROM {tree_sql.IMPORTANCE}""",
    ),
    "k6_tree_top_features": sql(
        _ON_DEMAND_TREE,
        f"""SELECT feature, round(importance + 1e-9, 6) AS importance
FROM {tree_sql.IMPORTANCE} ORDER BY 2 DESC, 1 LIMIT 10""",
    ),
    "l7_delay_metrics_check": "SELECT * FROM (VALUES ('Accuracy', 0e0), ('F1_Score', 0e0)) t(metric, gap)",
    "l8_delay_risk_check": sql(
        _ON_LOGISTICS,
        "SELECT count(DISTINCT shipment_id) AS shipments, 0::BIGINT AS outside FROM logistics",
    ),
    "l9_demand_importance_check": sql(
        _ON_ROWS, _feature_names("rows_", demand.CATEGORICAL, demand.NUMERIC)
    ),
    "l9_delay_importance_check": sql(
        _ON_LOGISTICS, _feature_names("logistics", delay.CATEGORICAL, delay.NUMERIC)
    ),
    "a8_batch_job": sql(_ON_BRIDGE, sizes(_TABLE_SIZES)),
    "b1_revenue": retail_column("revenue"),
    "b2_forecast_error": retail_column("forecast_error"),
    "b3_forecast_abs_error": retail_column("forecast_abs_error"),
    "b4_forecast_ape": retail_column("forecast_ape"),
    "b5_stockout_occurred": retail_column("stockout_occurred"),
    "b6_stockout_risk": retail_column("stockout_risk"),
    "b7_days_of_supply": series_column("days_of_supply"),
    "b8_overstock_flag": series_column("overstock_flag"),
    "b9_price_gap": retail_column("price_gap_vs_competitor"),
    "b10_priced_above": retail_column("priced_above_competitor"),
    "b11_naive_ma7_forecast": series_column("naive_ma7_forecast"),
    "b12_year": retail_column("year"),
    "b13_month": sql(
        _ON_BOTH,
        """SELECT month, retail_rows, shipments
FROM (SELECT month, count(*) AS retail_rows FROM rows_ GROUP BY month)
FULL JOIN (SELECT month, count(*) AS shipments FROM shipments GROUP BY month) USING (month)""",
    ),
    "b14_day_of_week": retail_column("day_of_week"),
    "b15_delay_reason": shipment_column("logistics_delay_reason"),
    "b16_on_time_flag": shipment_column("on_time_flag"),
    "b17_delivered_flag": shipment_column("delivered_flag"),
    "b18_date": shipment_column("date"),
    "b19_hour": shipment_column("hour"),
    "b20_month_number": retail_column("cast(month(date) AS int) AS month_num"),
    "b21_perfect_order": sql(
        _ON_BRIDGE,
        """SELECT month, store_id, product_id, stockout_occurred, delivered_on_time,
  perfect_order FROM bridge""",
    ),
    "b22_projection": sql(_ON_SHIPMENTS, f"SELECT {DETAIL} FROM shipments"),
    "b23_optional_columns": sql(
        _ON_BRIDGE,
        """SELECT * EXCLUDE (waiting_time, shipment_status, forecast_ape, delay_risk_score) FROM bridge""",
    ),
    "b24_rename": shipment_column("on_time_flag AS delivered_on_time"),
    "b25_percent": sql(
        _ON_ROWS,
        """SELECT region, round(avg(stockout_occurred) * 1e2 + 1e-9, 6) AS stockout_rate_pct
FROM rows_ GROUP BY region""",
    ),
    "b26_round_half_even": shipment_column("round_even(waiting_time / 8, 1) AS waiting_eighths"),
    "b27_promo_lift_pct": sql(
        _ON_RETAIL, f"SELECT category, promo_lift_pct FROM ({PROMO_LIFT})"
    ),
    "c1_delayed": sql(
        _ON_SHIPMENTS,
        "SELECT shipment_id, logistics_delay_reason FROM shipments WHERE logistics_delay = 1",
    ),
    "c2_membership": sql(
        _ON_RETAIL, f"SELECT {KEY}, region FROM retail WHERE region IN ('ASIA', 'EUROPE')"
    ),
    "c3_date_range": sql(
        _ON_RETAIL,
        f"""SELECT {KEY}, units_sold FROM retail
WHERE date BETWEEN DATE '1996-03-15' AND DATE '1999-09-30'""",
    ),
    "c4_conjunction": sql(
        _ON_RETAIL,
        f"SELECT {KEY}, region, category, units_sold FROM retail WHERE {PICKED_RETAIL}",
    ),
    "c5_filter_scope": sql(
        _ON_BRIDGE,
        sizes(
            {
                "retail": rows_in(f"rows_ WHERE {PICKED_RETAIL}"),
                "logistics": rows_in(f"shipments WHERE {PICKED_TRUCKS}"),
                "bridge": rows_in(f"bridge WHERE {IN_CATEGORY}"),
                "promo": groups("category", f"rows_ WHERE {IN_CATEGORY}"),
                "perfect_order": groups("category", f"bridge WHERE {IN_CATEGORY}"),
            }
        ),
    ),
    "c6_empty_selection": sql(
        _ON_BRIDGE,
        f"""SELECT {money("total_revenue")}, {units()},
  {mean("stockout_occurred", "stockout_rate")},
  (SELECT avg(on_time_flag) FROM shipments WHERE asset_id = 'NO SUCH TRUCK') AS on_time_rate,
  (SELECT avg(perfect_order) FROM bridge WHERE category = 'NO SUCH CATEGORY')
    AS perfect_order_rate,
  CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS is_empty
FROM rows_ WHERE category = 'NO SUCH CATEGORY'""",
    ),
    "c7_region_choices": sql(_ON_RETAIL, "SELECT DISTINCT region FROM retail"),
    "c7_category_choices": sql(_ON_RETAIL, "SELECT DISTINCT category FROM retail"),
    "c7_truck_choices": sql(_ON_LOGISTICS, "SELECT DISTINCT asset_id FROM logistics"),
    "c8_date_span": sql(
        _ON_RETAIL, "SELECT min(date) AS min_date, max(date) AS max_date FROM retail"
    ),
    "c9_metric_lookup": sql(
        _ON_HELD_OUT, f"SELECT round({wape('demand_forecast')} + 1e-9, 6) AS supplied FROM held_out"
    ),
    "j1_bridge_pairing": sql(_ON_BRIDGE, f"SELECT {BRIDGE_COLUMNS} FROM bridge"),
    "j2_baseline_of_test_rows": retail_column(
        "units_sold, naive_ma7_forecast", _ON_HELD_OUT, "held_out"
    ),
    "j3_global_mean": sql(
        _ON_RETAIL,
        """SELECT store_id, product_id,
  round((SELECT avg(units_sold) FROM retail) + 1e-9, 6) AS fill
FROM retail GROUP BY store_id, product_id""",
    ),
    "j4_series_mean_on_rows": series_column("avg_daily_sales_7d"),
    "g1_retail_kpi_daily": sql(
        _ON_CLEANED,
        f"""SELECT date, region, category, {units()}, {units("units_ordered")}, {money()},
  {mean("inventory_level", "avg_inventory")}, {mean("forecast_ape", "forecast_ape")},
  {mean("stockout_occurred", "stockout_rate")}, {mean("overstock_flag", "overstock_rate")},
  {mean("days_of_supply", "avg_days_of_supply")}, {mean("holiday_promotion", "promo_share")}
FROM cleaned WHERE region IS NOT NULL AND category IS NOT NULL
GROUP BY date, region, category""",
    ),
    "g2_retail_kpi_monthly": sql(
        _ON_CLEANED,
        f"""SELECT month, region, category, {units()}, {money()},
  {mean("forecast_ape", "forecast_mape")}, {mean("stockout_occurred", "stockout_rate")},
  {mean("days_of_supply", "avg_days_of_supply")}
FROM cleaned WHERE region IS NOT NULL AND category IS NOT NULL
GROUP BY month, region, category""",
    ),
    "g3_monthly_overall": sql(
        _ON_CLEANED,
        f"""SELECT month, {money()}, {units()},
  round(sum(forecast_abs_error) / nullif(sum(units_sold), 0) * 1e2 + 1e-9, 6) AS forecast_wape_pct,
  round(avg(stockout_occurred) * 1e2 + 1e-9, 6) AS stockout_rate_pct,
  {mean("days_of_supply", "avg_days_of_supply")}
FROM cleaned GROUP BY month""",
    ),
    "g4_category_summary": sql(_ON_CLEANED, f"{SUMMARY} GROUP BY category"),
    "g5_promo_lift": sql(_ON_RETAIL, PROMO_LIFT),
    "g6_asset_kpi": sql(_ON_SHIPMENTS, ASSETS),
    "g7_traffic_kpi": sql(
        _ON_SHIPMENTS,
        f"""SELECT traffic_status, count(*) AS shipments,
  {mean("on_time_flag", "on_time_rate")}, {mean("waiting_time", "avg_waiting_time")}
FROM shipments GROUP BY traffic_status""",
    ),
    "g8_delay_reason_kpi": causes("share_of_delays_pct", "round_even({}, 1)"),
    "g9_monthly_otd": sql(_ON_SHIPMENTS, MONTHLY_OTD),
    "g10_replenishment_events": sql(
        _ON_EVENTS,
        """SELECT * REPLACE (round(units_ordered + 1e-9, 6) AS units_ordered,
  round(forecast_ape + 1e-9, 6) AS forecast_ape) FROM events_""",
    ),
    "g11_perfect_order_by_category": sql(_ON_BRIDGE, f"{PERFECT} GROUP BY category"),
    "g12_kpi_cards": sql(
        _ON_BRIDGE,
        f"""SELECT {money("total_revenue")}, {units()},
  {mean("stockout_occurred", "stockout_rate")},
  (SELECT round(avg(on_time_flag) + 1e-9, 6) FROM shipments WHERE {PICKED_TRUCKS}) AS on_time_rate,
  (SELECT round(avg(perfect_order) + 1e-9, 6) FROM bridge WHERE {IN_CATEGORY}) AS perfect_order_rate
FROM rows_ WHERE {PICKED_RETAIL}""",
    ),
    "g13_revenue_by_category": sql(
        _ON_ROWS,
        f"SELECT category, {money()} FROM rows_ WHERE {PICKED_RETAIL} GROUP BY category",
    ),
    "g14_monthly_revenue": sql(
        _ON_ROWS, f"SELECT month, {money()} FROM rows_ WHERE {PICKED_RETAIL} GROUP BY month"
    ),
    "g15_stockout_by_category": sql(
        _ON_ROWS,
        f"""SELECT category, {mean("stockout_occurred", "stockout_rate")}
FROM rows_ WHERE {PICKED_RETAIL} GROUP BY category""",
    ),
    "g16_on_time_by_traffic": sql(
        _ON_SHIPMENTS,
        f"""SELECT traffic_status, {mean("on_time_flag", "on_time_rate")}
FROM shipments WHERE {PICKED_TRUCKS} GROUP BY traffic_status""",
    ),
    "g17_delay_causes": causes("share_pct", "round({} + 1e-9, 6)", PICKED_TRUCKS),
    "g18_truck_table": sql(_ON_SHIPMENTS, f"{TRUCKS} WHERE {PICKED_TRUCKS} GROUP BY asset_id"),
    "g19_monthly_on_time": sql(
        _ON_SHIPMENTS,
        f"""SELECT month, {mean("on_time_flag", "on_time_rate")}
FROM shipments WHERE {PICKED_TRUCKS} GROUP BY month""",
    ),
    "g20_rate_components": sql(
        _ON_BRIDGE,
        f"""SELECT round(avg(CASE WHEN stockout_occurred = 0 THEN 1 ELSE 0 END) * 1e2 + 1e-9, 6)
    AS stockout_free_pct,
  round(avg(delivered_on_time) * 1e2 + 1e-9, 6) AS on_time_pct
FROM bridge WHERE {IN_CATEGORY}""",
    ),
    "g21_headline_rates": sql(
        _ON_BRIDGE,
        f"""SELECT {mean("on_time_flag", "on_time_rate")},
  (SELECT round(avg(perfect_order) + 1e-9, 6) FROM bridge) AS perfect_order_rate FROM shipments""",
    ),
    "g22_filtered_promo": sql(
        _ON_RETAIL, f"SELECT * FROM ({PROMO_LIFT}) WHERE {IN_CATEGORY}"
    ),
    "g22_filtered_summary": sql(
        _ON_CLEANED, f"SELECT * FROM ({SUMMARY} GROUP BY category) WHERE {IN_CATEGORY}"
    ),
    "g22_filtered_perfect_order": sql(
        _ON_BRIDGE, f"SELECT * FROM ({PERFECT} GROUP BY category) WHERE {IN_CATEGORY}"
    ),
    "w1_avg_daily_sales_7d": series_column("avg_daily_sales_7d"),
    "w2_lagged_mean": series_column("naive_ma7_forecast"),
    "w3_share_of_total": causes("share_pct", "round({} + 1e-9, 6)"),
    "k1_sorted_panel": retail_column("units_sold", _ON_RETAIL, "retail") + f" ORDER BY {KEY}",
    "k2_sort_desc": sql(
        _ON_ROWS,
        f"SELECT category, {money()} FROM rows_ GROUP BY category ORDER BY revenue DESC",
    ),
    "k3_sort_asc": sql(
        _ON_SHIPMENTS, f"{TRUCKS} GROUP BY asset_id ORDER BY on_time_rate, asset_id"
    ),
    "k4_key_sorted": sql(_ON_SHIPMENTS, f"{MONTHLY_OTD} ORDER BY month"),
    "k5_latest_shipments": sql(
        _ON_SHIPMENTS,
        f"""SELECT {DETAIL} FROM shipments WHERE {PICKED_TRUCKS}
ORDER BY ts DESC, shipment_id LIMIT 200""",
    ),
    "k7_bridge_sample": sql(
        _ON_BRIDGE,
        f"""SELECT {BRIDGE_COLUMNS} FROM bridge b WHERE {IN_CATEGORY}
ORDER BY {hashed("'sample'", "b.month", "b.store_id", "b.product_id")},
  b.month, b.store_id, b.product_id LIMIT 200""",
    ),
    "k8_reason_frequency": sql(
        _ON_SHIPMENTS,
        """SELECT logistics_delay_reason, count(*) AS n FROM shipments
WHERE logistics_delay = 1 GROUP BY logistics_delay_reason ORDER BY n DESC""",
    ),
    "r1_pivot": sql(
        _ON_RETAIL,
        f"""SELECT category, round(a + 1e-9, 6) AS avg_units_no_promo,
  round(b + 1e-9, 6) AS avg_units_with_promo FROM ({PROMO})""",
    ),
    "r2_metric_unpivot": sql(
        _ON_HELD_OUT,
        f"""SELECT 'WAPE (%)' AS metric, 'naive_moving_avg_baseline' AS model,
  round({wape("naive_ma7_forecast")} + 1e-9, 6) AS wape FROM held_out
UNION ALL SELECT 'WAPE (%)' AS metric, 'supplied' AS model,
  round({wape("demand_forecast")} + 1e-9, 6) AS wape FROM held_out""",
    ),
    "r3_metric_table": sql(
        _ON_RULE,
        f"""SELECT 'Accuracy' AS metric, round(acc + 1e-9, 6) AS value
FROM (SELECT {_CONFUSION} FROM rule_)
UNION ALL SELECT 'F1_Score' AS metric, {_F1} AS value FROM (SELECT {_CONFUSION} FROM rule_)""",
    ),
    "r4_paired_columns": sql(
        _ON_BRIDGE,
        """SELECT month, store_id, product_id, units_ordered, asset_id, waiting_time
FROM bridge""",
    ),
    "m1_wape_baseline": sql(
        _ON_HELD_OUT, f"SELECT round({wape('naive_ma7_forecast')} + 1e-9, 6) AS wape FROM held_out"
    ),
    "m2_wape_zero_volume": sql(
        _ON_RETAIL,
        f"""SELECT l_orderkey, round({wape("demand_forecast")} + 1e-9, 6) AS wape
FROM retail GROUP BY l_orderkey""",
    ),
    "m3_mae_baseline": sql(
        _ON_HELD_OUT, f"SELECT {mean('abs(units_sold - naive_ma7_forecast)', 'mae')} FROM held_out"
    ),
    "m4_forecast_comparison": sql(
        _ON_HELD_OUT,
        f"""SELECT 'MAE' AS metric,
  {mean("abs(units_sold - naive_ma7_forecast)", "naive_moving_avg_baseline")},
  {mean("abs(units_sold - demand_forecast)", "supplied")} FROM held_out
UNION ALL SELECT 'WAPE (%)' AS metric,
  round({wape("naive_ma7_forecast")} + 1e-9, 6) AS naive_moving_avg_baseline,
  round({wape("demand_forecast")} + 1e-9, 6) AS supplied FROM held_out""",
    ),
    "m5_accuracy": sql(
        _ON_RULE, f"SELECT round(acc + 1e-9, 6) AS accuracy FROM (SELECT {_CONFUSION} FROM rule_)"
    ),
    "m6_f1_positive": sql(_ON_RULE, f"SELECT {_F1} AS f1 FROM (SELECT {_CONFUSION} FROM rule_)"),
    "m7_forecast_leakage": sql(
        _ON_RETAIL, "SELECT round(corr(demand_forecast, units_sold) + 1e-9, 6) AS correlation FROM retail"
    ),
    "m8_attribute_stability": sql(
        _ON_RETAIL,
        """SELECT store_id, product_id, count(DISTINCT category) AS categories,
  count(DISTINCT region) AS regions FROM retail GROUP BY store_id, product_id""",
    ),
    "l1_split": sql(_ON_HELD_OUT, f"SELECT {KEY} FROM held_out"),
    "l2_stratified_split": sql(_ON_RULE, "SELECT shipment_id, logistics_delay FROM rule_"),
    "l3_one_hot": sql(
        _ON_LOGISTICS,
        """SELECT shipment_id, 2 AS slots,
  CASE WHEN traffic_status = 'Clear' THEN 1e0 ELSE 0e0 END AS is_clear,
  CASE WHEN traffic_status = 'Detour' THEN 1e0 ELSE 0e0 END AS is_detour FROM logistics""",
    ),
    "l4_assembled": sql(
        _ON_LOGISTICS,
        """SELECT shipment_id, temperature AS f0, humidity AS f1, waiting_time AS f2,
  asset_utilization AS f3, user_transaction_amount AS f4, user_purchase_frequency AS f5,
  inventory_level AS f6 FROM logistics""",
    ),
}

#: Stored tables whose contents a query on the inputs also gives.
ORACLE |= {
    f"a8_{table}": ORACLE[key]
    for table, key in {
        "retail_kpi_daily": "g1_retail_kpi_daily",
        "retail_kpi_monthly": "g2_retail_kpi_monthly",
        "retail_monthly_overall": "g3_monthly_overall",
        "retail_category_summary": "g4_category_summary",
        "retail_promo_lift": "g5_promo_lift",
        "logistics_asset_kpi": "g6_asset_kpi",
        "logistics_traffic_kpi": "g7_traffic_kpi",
        "logistics_delay_reason_kpi": "g8_delay_reason_kpi",
        "logistics_monthly_otd": "g9_monthly_otd",
        "perfect_order_by_category": "g11_perfect_order_by_category",
    }.items()
}

#: What is stored beside the rows gives what the rows give, and panels of one pass over
#: the rows give what single panels give.
ORACLE |= {
    panel: ORACLE[key]
    for panel, key in {
        "c7_stored_regions": "c7_region_choices",
        "c7_stored_categories": "c7_category_choices",
        "c7_stored_trucks": "c7_truck_choices",
        "c8_stored_date_span": "c8_date_span",
        "g12_dashboard_cards": "g12_kpi_cards",
        "g13_dashboard_revenue": "g13_revenue_by_category",
        "g14_dashboard_monthly_revenue": "g14_monthly_revenue",
        "g15_dashboard_stockout": "g15_stockout_by_category",
        "g16_dashboard_on_time": "g16_on_time_by_traffic",
        "g17_dashboard_delay_causes": "g17_delay_causes",
        "g18_dashboard_trucks": "g18_truck_table",
        "g19_dashboard_monthly_on_time": "g19_monthly_on_time",
        "g20_dashboard_rates": "g20_rate_components",
    }.items()
}
