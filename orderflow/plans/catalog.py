"""Every operator as a query over the star-schema tables, by operator id."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from functools import lru_cache

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.functions import metrics
from orderflow.functions.expr import percent
from orderflow.models import delay, demand, forest, trees
from orderflow.operators import bridge, kpis, quality
from orderflow.operators.logistics import clean_logistics
from orderflow.operators.retail import (
    SERIES,
    clean_retail,
    sorted_panel,
    with_row_measures,
    with_series_measures,
)
from orderflow.plans import report
from orderflow.plans.pipeline import run_pipeline
from orderflow.plans.report import FilterSpec
from orderflow.session import shared_dir, stage
from orderflow.sources import csv_source, fixtures, tables
from orderflow.sources.schemas import (
    LOGISTICS,
    LOGISTICS_COLUMNS,
    DETAIL_COLUMNS,
    RETAIL,
    RETAIL_COLUMNS,
    column_name,
)

Query = Callable[[SparkSession, str], DataFrame]

KEY = list(fixtures.ROW_KEY)
TYPED_TIE_BREAKERS = ("l_orderkey:bigint", "l_linenumber:int", "l_partkey:bigint", "l_suppkey:bigint")
MONEY = ("revenue", "total_revenue")
#: Columns that the job adds to its inputs.
DERIVED = (
    "revenue", "forecast_error", "forecast_abs_error", "forecast_ape", "stockout_occurred",
    "stockout_risk", "price_gap_vs_competitor", "priced_above_competitor", "year", "month",
    "day_of_week", "avg_daily_sales_7d", "naive_ma7_forecast", "days_of_supply", "overstock_flag",
)
SHIPMENT_DERIVED = (
    "logistics_delay_reason", "on_time_flag", "delivered_flag", "date", "month", "hour",
)
FILTERS = FilterSpec(
    regions=("ASIA", "EUROPE"),
    categories=("ECONOMY", "PROMO", "SMALL"),
    start=dt.date(1996, 3, 15),
    end=dt.date(1999, 9, 30),
    trucks=("Truck_1", "Truck_3", "Truck_8"),
)
TREE = forest.ForestSize(trees=1, depth=2, exhaustive=True)
STUMP = forest.ForestSize(trees=1, depth=1, exhaustive=True)
#: Price differs on nearly every test row, so it has more values than Spark has bins.
TREE_NUMERIC = tuple(c for c in demand.NUMERIC if c != "price")
NO_MATCH = FilterSpec(categories=("NO SUCH CATEGORY",), trucks=("NO SUCH TRUCK",))


def rounded(df: DataFrame) -> DataFrame:
    """Aggregates to 4 decimals for money and 6 for the rest: sums depend on task order.

    Rates often end exactly on half a unit of the sixth digit; the nudge decides such ties.
    """
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns(
        {c: F.round(c, 4) if c in MONEY else F.round(F.col(c) + 1e-9, 6) for c in doubles}
    )


# --- inputs ---------------------------------------------------------------------------


def retail_rows(spark: SparkSession, sf: str) -> DataFrame:
    return with_row_measures(fixtures.retail_source(spark, sf))


def retail_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean_retail(
        fixtures.retail_source(spark, sf),
        fixtures.TIE_BREAKERS,
        rows_at_most=fixtures.fixture_rows(spark, sf),
    )


def retail_for_training(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that the demand model is compared on, with the moving average. As :func:`retail_cleaned`, from staged source rows.

    Long series are counted, cut into cells and averaged; each would join the source again.
    """
    source = fixtures.retail_source(spark, sf)
    return clean_retail(
        stage(source, "retail-input"),
        fixtures.TIE_BREAKERS,
        rows_at_most=fixtures.fixture_rows(spark, sf),
    )


def retail_series(spark: SparkSession, sf: str) -> DataFrame:
    """Series measures of the columns they need, staged: the overall mean reads them again."""
    source = fixtures.retail_source(spark, sf)
    needed = (*KEY, "units_sold", "inventory_level", "demand_forecast")
    return with_series_measures(
        stage(source.select(*needed), "series-input"),
        fixtures.TIE_BREAKERS,
        rows_at_most=fixtures.fixture_rows(spark, sf),
    )


def shipments(spark: SparkSession, sf: str) -> DataFrame:
    return clean_logistics(fixtures.logistics_source(spark, sf))


def scored_shipments(spark: SparkSession, sf: str) -> DataFrame:
    """Shipments with a score column that SQL can state, in place of the model's."""
    score = F.pmod(F.col("shipment_id") * 37, F.lit(1000)) / 1000
    return shipments(spark, sf).withColumn("delay_risk_score", score)


def paired(spark: SparkSession, sf: str) -> DataFrame:
    return bridge.build_bridge(retail_rows(spark, sf), scored_shipments(spark, sf))


@lru_cache(maxsize=4)
def _demand(app: str, sf: str) -> demand.DemandResult:
    spark = SparkSession.active()
    return demand.train_demand_model(
        retail_rows(spark, sf), KEY, cleaned=lambda: retail_for_training(spark, sf)
    )


@lru_cache(maxsize=4)
def _delay(app: str, sf: str) -> delay.DelayResult:
    spark = SparkSession.active()
    return delay.train_delay_model(shipments(spark, sf), "shipment_id")


def demand_result(spark: SparkSession, sf: str) -> demand.DemandResult:
    """One training run per session and input serves all queries on its outputs."""
    return _demand(spark.sparkContext.applicationId, sf)


def delay_result(spark: SparkSession, sf: str) -> delay.DelayResult:
    return _delay(spark.sparkContext.applicationId, sf)


@lru_cache(maxsize=4)
def _demand_tree(app: str, sf: str, size: forest.ForestSize) -> demand.DemandResult:
    spark = SparkSession.active()
    return demand.train_demand_model(
        retail_rows(spark, sf), KEY, size=size, numeric=TREE_NUMERIC,
        cleaned=lambda: retail_for_training(spark, sf),
    )


@lru_cache(maxsize=4)
def _delay_tree(app: str, sf: str, size: forest.ForestSize) -> delay.DelayResult:
    spark = SparkSession.active()
    return delay.train_delay_model(shipments(spark, sf), "shipment_id", size=size)


def demand_tree(
    spark: SparkSession, sf: str, size: forest.ForestSize = TREE
) -> demand.DemandResult:
    """One exhaustive tree, which SQL can grow too."""
    return _demand_tree(spark.sparkContext.applicationId, sf, size)


def delay_tree(spark: SparkSession, sf: str, size: forest.ForestSize = TREE) -> delay.DelayResult:
    return _delay_tree(spark.sparkContext.applicationId, sf, size)


@lru_cache(maxsize=4)
def _job(app: str, sf: str) -> str:
    spark = SparkSession.active()
    out = fresh_path(spark, "job")
    run_pipeline(
        spark,
        export_retail(spark, sf),
        export_logistics(spark, sf),
        out,
        tie_breakers=TYPED_TIE_BREAKERS,
    )
    return out


def job_output(spark: SparkSession, sf: str) -> str:
    """Folder with the 17 tables of one full batch run on exported CSV input."""
    return _job(spark.sparkContext.applicationId, sf)


# --- CSV exports used by the source queries ----------------------------------------------


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _export(df: DataFrame, headings: dict[str, T.DataType], name: str, pad: str = "") -> str:
    titles = {column_name(h): pad + h + pad for h in headings}
    path = fresh_path(df.sparkSession, name)
    renamed = df.toDF(*[titles.get(c, c) for c in df.columns])
    renamed.write.option("header", True).option("escape", '"').csv(path)
    return path


def export_retail(spark: SparkSession, sf: str, pad: str = "") -> str:
    return _export(fixtures.retail_source(spark, sf), RETAIL_COLUMNS, "retail-csv", pad)


def export_logistics(spark: SparkSession, sf: str) -> str:
    return _export(fixtures.logistics_source(spark, sf), LOGISTICS_COLUMNS, "logistics-csv")


def _keys_typed(df: DataFrame) -> DataFrame:
    """Pass-through key columns come back as text."""
    keys = {c: F.col(c).cast("bigint") for c in fixtures.TIE_BREAKERS}
    return df.withColumns({**keys, "l_linenumber": F.col("l_linenumber").cast("int")})


def a1_retail_csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    back = csv_source.read_retail_csv(spark, export_retail(spark, sf))
    return _keys_typed(back).select(*RETAIL.names, *fixtures.TIE_BREAKERS)


def a2_logistics_csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    back = csv_source.read_logistics_csv(spark, export_logistics(spark, sf))
    keyed = csv_source.with_input_position(back, "shipment_id")
    return keyed.select("shipment_id", *LOGISTICS.names)


def a3_header_normalisation(spark: SparkSession, sf: str) -> DataFrame:
    path = export_retail(spark, sf, pad="  ")
    back = csv_source.read_retail_csv(spark, path)
    return rounded(
        back.groupBy("store_id", "product_id").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("units_sold").alias("units_sold"),
            F.avg("holiday_promotion").alias("promo_share"),
        )
    )


def a4_parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    text = fixtures.logistics_source(spark, sf).select(
        "shipment_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
        F.date_format("ts", "yyyy-MM-dd").alias("date_text"),
    )
    return text.select(
        "shipment_id",
        csv_source.typed(F.col("ts_text"), T.TimestampNTZType()).alias("ts"),
        csv_source.typed(F.col("date_text"), T.DateType()).alias("date"),
    )


def _sunk(spark: SparkSession, df: DataFrame, name: str) -> str:
    """Folder where a table is written as Parquet and exported as CSV."""
    out = fresh_path(spark, "sink")
    tables.write_table(df, out, name)
    tables.export_csv(tables.read_table(spark, out, name), out, name)
    return f"{out}/csv/{name}"


def a5_sink_csv_export(spark: SparkSession, sf: str) -> DataFrame:
    """A KPI table written as Parquet and CSV, read back from the CSV with its headings."""
    path = _sunk(spark, g6_asset_kpi(spark, sf), "logistics_asset_kpi")
    types = (
        "Asset_ID string, Shipments bigint, On_Time_Rate double, Avg_Waiting_Time double, "
        "Avg_Asset_Utilization double, Delivered_Rate double"
    )
    return spark.read.schema(types).option("header", True).csv(path)


def a5_sink_small_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table of one CSV file."""
    path = _sunk(spark, g5_promo_lift(spark, sf), "retail_promo_lift")
    types = (
        "Category string, Avg_Units_No_Promo double, Avg_Units_With_Promo double, "
        "Promo_Lift_Pct double"
    )
    return spark.read.schema(types).option("header", True).csv(path)


def _sizes(named: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row count) of several tables."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in named.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result


def a6_report_tables(spark: SparkSession, sf: str) -> DataFrame:
    return _sizes(dict(tables.read_report_tables(spark, job_output(spark, sf))))


def a7_cached_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Panels over both row-level tables as the report keeps them; released with the session."""
    ready = tables.keep_in_memory(tables.read_report_tables(spark, job_output(spark, sf)))
    log, sold = ready["logistics_cleaned"], ready["retail_cleaned"]
    by_traffic = report.on_time_by_traffic(log).withColumnRenamed("traffic_status", "grp")
    by_truck = report.truck_table(log).select(F.col("asset_id").alias("grp"), "on_time_rate")
    by_category = report.stockout_by_category(sold).toDF("grp", "on_time_rate")
    result = by_traffic.union(by_truck).withColumn("panel", F.lit("on time"))
    return rounded(result.union(by_category.withColumn("panel", F.lit("stockout"))))


def a8_batch_job(spark: SparkSession, sf: str) -> DataFrame:
    out = job_output(spark, sf)
    return _sizes({name: tables.read_table(spark, out, name) for name in tables.TABLES})


def _stored(name: str, columns: Sequence[str] = ()) -> Query:
    """Contents of one table that the batch job has written."""
    def query(spark: SparkSession, sf: str) -> DataFrame:
        df = tables.read_table(spark, job_output(spark, sf), name)
        return rounded(df.select(*(columns or df.columns)))

    return query


def a8_bridge_perfect_order(spark: SparkSession, sf: str) -> DataFrame:
    """The stored bridge without the model's score."""
    df = tables.read_table(spark, job_output(spark, sf), "bridge_perfect_order")
    return rounded(df.drop("delay_risk_score"))


def a8_bridge_with_risk(spark: SparkSession, sf: str) -> DataFrame:
    """Events of the stored bridge whose score is that of their stored shipment."""
    out = job_output(spark, sf)
    pairs = tables.read_table(spark, out, "bridge_perfect_order")
    scores = tables.read_table(spark, out, "logistics_cleaned").select(
        "shipment_id", F.col("delay_risk_score").alias("_own")
    )
    same = pairs.join(scores, "shipment_id").where(
        (F.col("delay_risk_score") == F.col("_own")) & F.col("_own").between(0, 1)
    )
    return same.select(*bridge.EVENT_KEY, "shipment_id")


def _stored_picked(name: str) -> Query:
    """A stored table as the report filters it."""
    return lambda spark, sf: rounded(
        FILTERS.by_category(tables.read_table(spark, job_output(spark, sf), name))
    )


# --- row-level columns -------------------------------------------------------------------


def _retail_column(name: str) -> Query:
    return lambda spark, sf: retail_rows(spark, sf).select(*KEY, name)


def _series_column(name: str) -> Query:
    return lambda spark, sf: retail_series(spark, sf).select(*KEY, name)


def _shipment_column(name: str) -> Query:
    return lambda spark, sf: shipments(spark, sf).select("shipment_id", name)


def b13_month(spark: SparkSession, sf: str) -> DataFrame:
    """Months of both row-level tables with their row counts."""
    sold = retail_rows(spark, sf).groupBy("month").agg(F.count(F.lit(1)).alias("retail_rows"))
    sent = shipments(spark, sf).groupBy("month").agg(F.count(F.lit(1)).alias("shipments"))
    return sold.join(sent, "month", "full")


def b20_month_number(spark: SparkSession, sf: str) -> DataFrame:
    return demand.demand_features(
        fixtures.retail_source(spark, sf)
        .withColumn("day_of_week", F.date_format("date", "EEEE"))
        .withColumn(demand.BASELINE, F.lit(0.0)),
        KEY,
    ).select(*KEY, "month_num")


def b21_perfect_order(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("stockout_occurred", "delivered_on_time", "perfect_order")
    return paired(spark, sf).select(*bridge.EVENT_KEY, *columns)


def b22_projection(spark: SparkSession, sf: str) -> DataFrame:
    return scored_shipments(spark, sf).select("shipment_id", *DETAIL_COLUMNS)


def b23_optional_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The bridge of a shipment table that lacks three of the optional columns."""
    few = shipments(spark, sf).drop("waiting_time", "shipment_status")
    return bridge.build_bridge(retail_rows(spark, sf), few).drop("forecast_ape")


def b24_rename(spark: SparkSession, sf: str) -> DataFrame:
    return shipments(spark, sf).select(
        "shipment_id", F.col("on_time_flag").alias("delivered_on_time")
    )


def b25_percent(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        retail_rows(spark, sf)
        .groupBy("region")
        .agg(percent(F.avg("stockout_occurred")).alias("stockout_rate_pct"))
    )


def b26_round_half_even(spark: SparkSession, sf: str) -> DataFrame:
    """Eighths of the waiting time hit exact ties at one decimal."""
    return shipments(spark, sf).select(
        "shipment_id", F.bround(F.col("waiting_time") / 8, 1).alias("waiting_eighths")
    )


# --- filters -----------------------------------------------------------------------------


def c1_delayed(spark: SparkSession, sf: str) -> DataFrame:
    late = shipments(spark, sf).where(F.col("logistics_delay") == 1)
    return late.select("shipment_id", "logistics_delay_reason")


def c2_membership(spark: SparkSession, sf: str) -> DataFrame:
    spec = FilterSpec(regions=FILTERS.regions)
    return spec.retail(fixtures.retail_source(spark, sf)).select(*KEY, "region")


def c3_date_range(spark: SparkSession, sf: str) -> DataFrame:
    spec = FilterSpec(start=FILTERS.start, end=FILTERS.end)
    return spec.retail(fixtures.retail_source(spark, sf)).select(*KEY, "units_sold")


def c4_conjunction(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("region", "category", "units_sold")
    return FILTERS.retail(fixtures.retail_source(spark, sf)).select(*KEY, *columns)


def c5_filter_scope(spark: SparkSession, sf: str) -> DataFrame:
    rows, log, pairs = retail_rows(spark, sf), shipments(spark, sf), paired(spark, sf)
    return _sizes(
        {
            "retail": FILTERS.retail(rows),
            "logistics": FILTERS.logistics(log),
            "bridge": FILTERS.by_category(pairs),
            "promo": FILTERS.by_category(kpis.units_by_promo(rows)),
            "perfect_order": FILTERS.by_category(bridge.perfect_order_by_category(pairs)),
        }
    )


def c6_empty_selection(spark: SparkSession, sf: str) -> DataFrame:
    rows = NO_MATCH.retail(retail_rows(spark, sf))
    log = NO_MATCH.logistics(shipments(spark, sf))
    empty = report.nothing_selected(rows, log)
    cards = report.kpi_cards(rows, log, NO_MATCH.by_category(paired(spark, sf)))
    return cards.withColumn("is_empty", F.lit(int(empty)))


def _choices(source: Query, column: str) -> Query:
    return lambda spark, sf: report.choices(source(spark, sf), column)


def c8_date_span(spark: SparkSession, sf: str) -> DataFrame:
    return report.date_span(fixtures.retail_source(spark, sf))


# --- metrics on forecasts that SQL can check -------------------------------------------------


def held_out(spark: SparkSession, sf: str) -> DataFrame:
    return forest.split(retail_series(spark, sf), KEY)[1]


def two_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """Comparison of the moving average with the forecast column of the source."""
    return metrics.forecast_comparison(
        held_out(spark, sf),
        "units_sold",
        {"naive_moving_avg_baseline": "naive_ma7_forecast", "supplied": "demand_forecast"},
    )


def c9_metric_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.metric_value(two_forecasts(spark, sf), "WAPE (%)", "supplied"))


def _one_metric(measure: Callable[[Column, Column], Column], name: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        value = measure(F.col("units_sold"), F.col("naive_ma7_forecast"))
        return rounded(held_out(spark, sf).agg(value.alias(name)))

    return query


def m2_wape_zero_volume(spark: SparkSession, sf: str) -> DataFrame:
    """Some orders have no volume at all; their WAPE is missing."""
    value = metrics.wape(F.col("units_sold"), F.col("demand_forecast"))
    rows = fixtures.retail_source(spark, sf)
    return rounded(rows.groupBy("l_orderkey").agg(value.alias("wape")))


def heavy_traffic_rule(spark: SparkSession, sf: str) -> DataFrame:
    """Test shipments with a rule as classifier: heavy traffic means late."""
    log = shipments(spark, sf)
    part = forest.stratified_split(log, ["shipment_id"], delay.TARGET)[1]
    return part.withColumn("prediction", (F.col("traffic_status") == "Heavy").cast("int"))


def _rule_metric(measure: Callable[[Column, Column], Column], name: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        value = measure(F.col(delay.TARGET), F.col("prediction"))
        return rounded(heavy_traffic_rule(spark, sf).agg(value.alias(name)))

    return query


def r3_metric_table(spark: SparkSession, sf: str) -> DataFrame:
    rule = heavy_traffic_rule(spark, sf)
    return rounded(metrics.classification_metrics(rule, delay.TARGET, "prediction"))


# --- joins and windows --------------------------------------------------------------------


def j1_bridge_pairing(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(paired(spark, sf))


def j2_baseline_of_test_rows(spark: SparkSession, sf: str) -> DataFrame:
    return held_out(spark, sf).select(*KEY, "units_sold", "naive_ma7_forecast")


def j3_global_mean(spark: SparkSession, sf: str) -> DataFrame:
    """First row of every series: the moving average is missing and the mean steps in."""
    rows = retail_series(spark, sf)
    first = rows.groupBy(*SERIES).agg(
        F.min_by("naive_ma7_forecast", F.struct("date", *fixtures.TIE_BREAKERS)).alias("fill")
    )
    return rounded(first)


def k1_sorted_panel(spark: SparkSession, sf: str) -> DataFrame:
    return sorted_panel(
        fixtures.retail_source(spark, sf).select(*KEY, "units_sold"), fixtures.TIE_BREAKERS
    )


def k4_key_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(kpis.logistics_monthly_otd(shipments(spark, sf)).orderBy("month"))


def k5_latest_shipments(spark: SparkSession, sf: str) -> DataFrame:
    return report.latest_shipments(FILTERS.logistics(scored_shipments(spark, sf)))


def k7_bridge_sample(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.bridge_sample(FILTERS.by_category(paired(spark, sf))))


def k8_reason_frequency(spark: SparkSession, sf: str) -> DataFrame:
    late = shipments(spark, sf).where(F.col("logistics_delay") == 1)
    counts = late.groupBy("logistics_delay_reason").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "logistics_delay_reason")


# --- aggregates -----------------------------------------------------------------------------


def _agg(build: Callable[[DataFrame], DataFrame], source: Query) -> Query:
    return lambda spark, sf: rounded(build(source(spark, sf)))


def _panel(
    build: Callable[[DataFrame], DataFrame],
    source: Query,
    limit: Callable[[DataFrame], DataFrame],
) -> Query:
    """A report panel over the selected rows."""
    return lambda spark, sf: rounded(build(limit(source(spark, sf))))


g4_category_summary = _agg(kpis.retail_category_summary, retail_cleaned)
g5_promo_lift = _agg(kpis.retail_promo_lift, fixtures.retail_source)
g6_asset_kpi = _agg(kpis.logistics_asset_kpi, shipments)


def g12_kpi_cards(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        report.kpi_cards(
            FILTERS.retail(retail_rows(spark, sf)),
            FILTERS.logistics(shipments(spark, sf)),
            FILTERS.by_category(paired(spark, sf)),
        )
    )


@lru_cache(maxsize=4)
def _dashboard(app: str, sf: str) -> report.Dashboard:
    spark = SparkSession.active()
    rows = retail_rows(spark, sf), shipments(spark, sf), paired(spark, sf)
    return report.Dashboard.of(FILTERS, *rows)


def _on_dashboard(panel: Callable[[report.Dashboard], DataFrame]) -> Query:
    """A card row or panel of the selection, from one pass for all of them."""
    return lambda spark, sf: rounded(panel(_dashboard(spark.sparkContext.applicationId, sf)))


def g21_headline_rates(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.headline_rates(shipments(spark, sf), paired(spark, sf)))


# --- models -----------------------------------------------------------------------------------


def l1_split(spark: SparkSession, sf: str) -> DataFrame:
    return forest.split(fixtures.retail_source(spark, sf), KEY)[1].select(*KEY)


def l2_stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    log = fixtures.logistics_source(spark, sf)
    part = forest.stratified_split(log, ["shipment_id"], delay.TARGET)[1]
    return part.select("shipment_id", delay.TARGET)


def l3_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Traffic encoder fitted without ``Heavy``: that value is unseen and gives zeros."""
    log = fixtures.logistics_source(spark, sf).select("shipment_id", "traffic_status")
    encoder = Pipeline(stages=forest.one_hot_stages(["traffic_status"]))
    fitted = encoder.fit(log.where(F.col("traffic_status") != "Heavy"))
    slots = vector_to_array("traffic_status_onehot")
    return fitted.transform(log).select(
        "shipment_id",
        F.size(slots).alias("slots"),
        slots[0].alias("is_clear"),
        slots[1].alias("is_detour"),
    )


def l4_assembled(spark: SparkSession, sf: str) -> DataFrame:
    log = fixtures.logistics_source(spark, sf)
    numbers = vector_to_array("features")
    columns = [numbers[i].alias(f"f{i}") for i in range(len(delay.NUMERIC))]
    return forest.assembler([], delay.NUMERIC).transform(log).select("shipment_id", *columns)


def l5_fit_predict(spark: SparkSession, sf: str) -> DataFrame:
    scored = delay_result(spark, sf).predictions
    return scored.select("shipment_id", delay.TARGET, "prediction")


def l6_demand_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return demand_result(spark, sf).predictions.select(*KEY, "units_sold", "prediction")


def l7_delay_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return delay_result(spark, sf).metrics


def l8_delay_risk(spark: SparkSession, sf: str) -> DataFrame:
    return delay_result(spark, sf).scored.select("shipment_id", "delay_risk_score")


def l7_delay_metrics_check(spark: SparkSession, sf: str) -> DataFrame:
    """The model's metrics minus those counted again from its predictions."""
    result = delay_result(spark, sf)
    label, guess = F.col(delay.TARGET), F.col("prediction")
    hit = F.count_if((label == 1) & (guess == 1))
    again = result.predictions.agg(
        F.avg((label == guess).cast("int")).alias("Accuracy"),
        (2 * hit / (F.count_if(label == 1) + F.count_if(guess == 1))).alias("F1_Score"),
    )
    parts = [again.select(F.lit(m).alias("metric"), F.col(m).alias("again")) for m in again.columns]
    both = result.metrics.join(parts[0].union(parts[1]), "metric")
    return both.select("metric", F.round(F.abs(F.col("value") - F.col("again")), 6).alias("gap"))


def l8_delay_risk_check(spark: SparkSession, sf: str) -> DataFrame:
    """Shipments scored, and scores outside 0 to 1."""
    score = F.col("delay_risk_score")
    return delay_result(spark, sf).scored.agg(
        F.countDistinct("shipment_id").alias("shipments"),
        F.count_if(~score.between(0, 1) | score.isNull()).alias("outside"),
    )


def l6_demand_check(spark: SparkSession, sf: str) -> DataFrame:
    """Rows predicted, and predictions outside the range of units sold."""
    rows = demand_result(spark, sf).predictions
    return rows.agg(
        F.count("prediction").alias("predicted"),
        F.count_if(~F.col("prediction").between(0, 50)).alias("outside"),
    )


def _tree_nodes(result: Query) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        nodes = trees.tree_nodes(result(spark, sf).model).drop("tree")
        return nodes.withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in ("gain", "prediction")})

    return query


def l5_tree_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return delay_tree(spark, sf).predictions.select("shipment_id", delay.TARGET, "prediction")


def l6_tree_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(demand_tree(spark, sf).predictions.select(*KEY, "units_sold", "prediction"))


def l8_tree_risk(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(delay_tree(spark, sf).scored.select("shipment_id", "delay_risk_score"))


def l9_tree_importance(spark: SparkSession, sf: str) -> DataFrame:
    """From the table of nodes, which the model's own importances must equal."""
    fitted = delay_tree(spark, sf)
    nodes = trees.tree_nodes(fitted.model)
    own = trees.node_importance(nodes, fitted.importance)
    given = fitted.importance.withColumnRenamed("importance", "given")
    return rounded(own.join(given, "feature")).select(
        "feature", "importance", F.abs(F.round(F.col("given") - F.col("importance"), 5)).alias("gap"))


def k6_tree_top_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(report.top_features(demand_tree(spark, sf).importance))


def _importance_check(result: Query) -> Query:
    """Feature names, and the sum of all importances on each row."""
    def query(spark: SparkSession, sf: str) -> DataFrame:
        table = result(spark, sf).importance
        whole = table.agg(F.round(F.sum("importance"), 6)).scalar()
        return table.select("feature", whole.alias("total"))

    return query


QUERIES: dict[str, Query] = {
    "a1_retail_csv_round_trip": a1_retail_csv_round_trip,
    "a2_logistics_csv_round_trip": a2_logistics_csv_round_trip,
    "a3_header_normalisation": a3_header_normalisation,
    "a4_parse_dates": a4_parse_dates,
    "a5_sink_csv_export": a5_sink_csv_export,
    "a6_report_tables": a6_report_tables,
    "a7_cached_tables": a7_cached_tables,
    "a8_batch_job": a8_batch_job,
    "a5_sink_small_table": a5_sink_small_table,
    "a8_retail_cleaned": _stored("retail_cleaned", (*KEY, *DERIVED)),
    "a8_logistics_cleaned": _stored("logistics_cleaned", ("shipment_id", *SHIPMENT_DERIVED)),
    "a8_retail_kpi_daily": _stored("retail_kpi_daily"),
    "a8_retail_kpi_monthly": _stored("retail_kpi_monthly"),
    "a8_retail_monthly_overall": _stored("retail_monthly_overall"),
    "a8_retail_category_summary": _stored("retail_category_summary"),
    "a8_retail_promo_lift": _stored("retail_promo_lift"),
    "a8_logistics_asset_kpi": _stored("logistics_asset_kpi"),
    "a8_logistics_traffic_kpi": _stored("logistics_traffic_kpi"),
    "a8_logistics_delay_reason_kpi": _stored("logistics_delay_reason_kpi"),
    "a8_logistics_monthly_otd": _stored("logistics_monthly_otd"),
    "a8_perfect_order_by_category": _stored("perfect_order_by_category"),
    "a8_bridge_perfect_order": a8_bridge_perfect_order,
    "a8_bridge_with_risk": a8_bridge_with_risk,
    "b1_revenue": _retail_column("revenue"),
    "b2_forecast_error": _retail_column("forecast_error"),
    "b3_forecast_abs_error": _retail_column("forecast_abs_error"),
    "b4_forecast_ape": _retail_column("forecast_ape"),
    "b5_stockout_occurred": _retail_column("stockout_occurred"),
    "b6_stockout_risk": _retail_column("stockout_risk"),
    "b7_days_of_supply": _series_column("days_of_supply"),
    "b8_overstock_flag": _series_column("overstock_flag"),
    "b9_price_gap": _retail_column("price_gap_vs_competitor"),
    "b10_priced_above": _retail_column("priced_above_competitor"),
    "b11_naive_ma7_forecast": _series_column("naive_ma7_forecast"),
    "b12_year": _retail_column("year"),
    "b13_month": b13_month,
    "b14_day_of_week": _retail_column("day_of_week"),
    "b15_delay_reason": _shipment_column("logistics_delay_reason"),
    "b16_on_time_flag": _shipment_column("on_time_flag"),
    "b17_delivered_flag": _shipment_column("delivered_flag"),
    "b18_date": _shipment_column("date"),
    "b19_hour": _shipment_column("hour"),
    "b20_month_number": b20_month_number,
    "b21_perfect_order": b21_perfect_order,
    "b22_projection": b22_projection,
    "b23_optional_columns": b23_optional_columns,
    "b24_rename": b24_rename,
    "b25_percent": b25_percent,
    "b26_round_half_even": b26_round_half_even,
    "b27_promo_lift_pct": lambda spark, sf: g5_promo_lift(spark, sf).select(
        "category", "promo_lift_pct"
    ),
    "c1_delayed": c1_delayed,
    "c2_membership": c2_membership,
    "c3_date_range": c3_date_range,
    "c4_conjunction": c4_conjunction,
    "c5_filter_scope": c5_filter_scope,
    "c6_empty_selection": c6_empty_selection,
    "c7_region_choices": _choices(fixtures.retail_source, "region"),
    "c7_category_choices": _choices(fixtures.retail_source, "category"),
    "c7_truck_choices": _choices(fixtures.logistics_source, "asset_id"),
    "c8_date_span": c8_date_span,
    "c7_stored_regions": lambda spark, sf: report.stored_choices(
        spark, job_output(spark, sf), "region"),
    "c7_stored_categories": lambda spark, sf: report.stored_choices(
        spark, job_output(spark, sf), "category"),
    "c7_stored_trucks": lambda spark, sf: report.stored_choices(
        spark, job_output(spark, sf), "asset_id"),
    "c8_stored_date_span": lambda spark, sf: report.stored_date_span(spark, job_output(spark, sf)),
    "c9_metric_lookup": c9_metric_lookup,
    "j1_bridge_pairing": j1_bridge_pairing,
    "j2_baseline_of_test_rows": j2_baseline_of_test_rows,
    "j3_global_mean": j3_global_mean,
    "j4_series_mean_on_rows": _series_column("avg_daily_sales_7d"),
    "g1_retail_kpi_daily": _agg(kpis.retail_kpi_daily, retail_cleaned),
    "g2_retail_kpi_monthly": _agg(kpis.retail_kpi_monthly, retail_cleaned),
    "g3_monthly_overall": _agg(kpis.retail_monthly_overall, retail_cleaned),
    "g4_category_summary": g4_category_summary,
    "g5_promo_lift": g5_promo_lift,
    "g6_asset_kpi": g6_asset_kpi,
    "g7_traffic_kpi": _agg(kpis.logistics_traffic_kpi, shipments),
    "g8_delay_reason_kpi": _agg(kpis.logistics_delay_reason_kpi, shipments),
    "g9_monthly_otd": _agg(kpis.logistics_monthly_otd, shipments),
    "g10_replenishment_events": _agg(bridge.replenishment_events, retail_rows),
    "g11_perfect_order_by_category": _agg(bridge.perfect_order_by_category, paired),
    "g12_kpi_cards": g12_kpi_cards,
    "g13_revenue_by_category": _panel(report.revenue_by_category, retail_rows, FILTERS.retail),
    "g14_monthly_revenue": _panel(report.monthly_revenue, retail_rows, FILTERS.retail),
    "g15_stockout_by_category": _panel(report.stockout_by_category, retail_rows, FILTERS.retail),
    "g16_on_time_by_traffic": _panel(report.on_time_by_traffic, shipments, FILTERS.logistics),
    "g17_delay_causes": _panel(report.delay_causes, shipments, FILTERS.logistics),
    "g18_truck_table": _panel(report.truck_table, shipments, FILTERS.logistics),
    "g19_monthly_on_time": _panel(report.monthly_on_time, shipments, FILTERS.logistics),
    "g12_dashboard_cards": _on_dashboard(report.Dashboard.cards),
    "g13_dashboard_revenue": _on_dashboard(report.Dashboard.revenue_by_category),
    "g14_dashboard_monthly_revenue": _on_dashboard(report.Dashboard.monthly_revenue),
    "g15_dashboard_stockout": _on_dashboard(report.Dashboard.stockout_by_category),
    "g16_dashboard_on_time": _on_dashboard(report.Dashboard.on_time_by_traffic),
    "g17_dashboard_delay_causes": _on_dashboard(report.Dashboard.delay_causes),
    "g18_dashboard_trucks": _on_dashboard(report.Dashboard.truck_table),
    "g19_dashboard_monthly_on_time": _on_dashboard(report.Dashboard.monthly_on_time),
    "g20_dashboard_rates": _on_dashboard(report.Dashboard.rate_components),
    "g20_rate_components": _panel(report.rate_components, paired, FILTERS.by_category),
    "g21_headline_rates": g21_headline_rates,
    "g22_filtered_promo": _stored_picked("retail_promo_lift"),
    "g22_filtered_summary": _stored_picked("retail_category_summary"),
    "g22_filtered_perfect_order": _stored_picked("perfect_order_by_category"),
    "w1_avg_daily_sales_7d": _series_column("avg_daily_sales_7d"),
    "w2_lagged_mean": _series_column("naive_ma7_forecast"),
    "w3_share_of_total": _agg(kpis.delay_reason_share, shipments),
    "k1_sorted_panel": k1_sorted_panel,
    "k2_sort_desc": _agg(report.revenue_by_category, retail_rows),
    "k3_sort_asc": _agg(report.truck_table, shipments),
    "k4_key_sorted": k4_key_sorted,
    "k5_latest_shipments": k5_latest_shipments,
    "k6_top_features": lambda spark, sf: report.top_features(demand_result(spark, sf).importance),
    "k7_bridge_sample": k7_bridge_sample,
    "k8_reason_frequency": k8_reason_frequency,
    "r1_pivot": _agg(kpis.units_by_promo, fixtures.retail_source),
    "r2_metric_unpivot": lambda spark, sf: rounded(
        metrics.melt_metric(two_forecasts(spark, sf), "WAPE (%)")
    ),
    "r3_metric_table": r3_metric_table,
    "r4_paired_columns": lambda spark, sf: paired(spark, sf).select(
        *bridge.EVENT_KEY, "units_ordered", "asset_id", "waiting_time"
    ),
    "m1_wape_baseline": _one_metric(metrics.wape, "wape"),
    "m2_wape_zero_volume": m2_wape_zero_volume,
    "m3_mae_baseline": _one_metric(metrics.mae, "mae"),
    "m4_model_comparison": lambda spark, sf: demand_result(spark, sf).comparison,
    "m4_forecast_comparison": lambda spark, sf: rounded(two_forecasts(spark, sf)),
    "m5_accuracy": _rule_metric(metrics.accuracy, "accuracy"),
    "m6_f1_positive": _rule_metric(metrics.f1_positive, "f1"),
    "m7_forecast_leakage": _agg(quality.forecast_leakage, fixtures.retail_source),
    "m8_attribute_stability": _agg(quality.attribute_stability, fixtures.retail_source),
    "l1_split": l1_split,
    "l2_stratified_split": l2_stratified_split,
    "l3_one_hot": l3_one_hot,
    "l4_assembled": l4_assembled,
    "l5_fit_predict": l5_fit_predict,
    "l6_demand_predictions": l6_demand_predictions,
    "l7_delay_metrics": l7_delay_metrics,
    "l8_delay_risk": l8_delay_risk,
    "l6_demand_check": l6_demand_check,
    "l7_delay_metrics_check": l7_delay_metrics_check,
    "l8_delay_risk_check": l8_delay_risk_check,
    "l9_demand_importance_check": _importance_check(demand_result),
    "l9_delay_importance_check": _importance_check(delay_result),
    "l5_tree_predictions": l5_tree_predictions,
    "l6_stump_nodes": _tree_nodes(lambda spark, sf: demand_tree(spark, sf, STUMP)),
    "l7_stump_nodes": _tree_nodes(lambda spark, sf: delay_tree(spark, sf, STUMP)),
    "l6_tree_nodes": _tree_nodes(demand_tree),
    "l6_tree_predictions": l6_tree_predictions,
    "l7_tree_nodes": _tree_nodes(delay_tree),
    "l8_tree_risk": l8_tree_risk,
    "l9_tree_importance": l9_tree_importance,
    "k6_tree_top_features": k6_tree_top_features,
    "l9_demand_importance": lambda spark, sf: demand_result(spark, sf).importance,
    "l9_delay_importance": lambda spark, sf: delay_result(spark, sf).importance,
}
