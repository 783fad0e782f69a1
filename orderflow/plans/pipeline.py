"""The batch run: two CSV inputs to 17 result tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from orderflow.models import delay, demand
from orderflow.models.forest import ForestSize
from orderflow.operators import bridge, kpis
from orderflow.operators.logistics import clean_logistics
from orderflow.operators.retail import LONG_SERIES_ROWS, SERIES, clean_retail
from orderflow.session import branches, staging_area
from orderflow.sources import tables, versions
from orderflow.sources.csv_source import (
    parse_columns,
    read_logistics_csv,
    read_retail_csv,
    with_input_position,
)

ROW_ID = "row_id"
SHIPMENT_ID = "shipment_id"
#: Counted up when a change of the code changes results, so that no run goes on from old ones.
RESULTS = 1

Table = Callable[[str, Callable[[], DataFrame]], DataFrame]


def run_pipeline(
    spark: SparkSession,
    retail_csv: str,
    logistics_csv: str,
    out_dir: str,
    *,
    tie_breakers: Sequence[str] = (ROW_ID,),
    demand_size: ForestSize = demand.SIZE,
    delay_size: ForestSize = delay.SIZE,
    long_rows: int = LONG_SERIES_ROWS,
) -> None:
    """Write all result tables below ``out_dir`` and publish them as one version.

    ``tie_breakers`` order the rows of one store, product and day; a column that the
    inputs do not declare is text unless given as ``name:type``.

    CSV text is parsed once, into Parquet. Each large table is written as soon as it is
    complete and later steps start from the written files, so they read only the columns
    they need and a lost executor costs one step at most. All KPI tables of one source
    come from one set of totals. The demand forest is grown beside the other tables. Readers
    see the tables of the version before until all are complete. A run that was stopped goes
    on, when started again with the same inputs and settings, after its last finished table;
    a published one is not repeated.
    """
    settings = (tuple(tie_breakers), demand_size, delay_size, long_rows)
    version = versions.version_of(spark, (retail_csv, logistics_csv), (RESULTS, *settings))
    run = versions.Run(spark, out_dir, version)
    if run.is_published:
        run.settle([tables.CSV])
        return
    with staging_area(spark):
        _build(run, retail_csv, logistics_csv, *settings)
    run.publish(tables.TABLES, [tables.CSV])


def _build(
    run: versions.Run,
    retail_csv: str,
    logistics_csv: str,
    tie_columns: Sequence[str],
    demand_size: ForestSize,
    delay_size: ForestSize,
    long_rows: int,
) -> None:
    spark = run.spark
    tie_breakers, extra = parse_columns(tie_columns)

    def table(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        return run.table(name, make, tables.write_table)

    scanned_retail = run.scratch(
        "retail", lambda: read_retail_csv(spark, retail_csv, extra=extra, located=True)
    )
    scanned_logistics = run.scratch(
        "logistics", lambda: read_logistics_csv(spark, logistics_csv, located=True)
    )
    with branches(spark) as branch:
        # The demand forest is most of the work; its passes over the rows leave cores idle in
        # between, which the other branch uses. The forest needs only the cleaned table.
        cleaned = branch(
            lambda: table(
                "retail_cleaned",
                lambda: clean_retail(
                    with_input_position(scanned_retail, ROW_ID), tie_breakers, long_rows=long_rows
                ),
            )
        )
        forecast = branch(
            lambda: _forecast_tables(
                run, table, cleaned.result(), [*SERIES, "date", *tie_breakers], demand_size
            )
        )
        _delay_tables(run, table, scanned_logistics, delay_size)
        logistics = spark.read.parquet(f"{run.folder}/logistics_cleaned")
        _kpi_tables(run, table, cleaned.result(), logistics)
        forecast.result()
    for name in tables.TABLES:
        if name not in tables.PARTITIONED:
            tables.export_csv(spark.read.parquet(f"{run.folder}/{name}"), run.folder, name)


def _delay_tables(run: versions.Run, table: Table, scanned: DataFrame, size: ForestSize) -> None:
    # One training gives several tables; it is repeated only if one of them is missing.
    trained = ("logistics_cleaned", "model_delay_metrics", "model_delay_feature_importance")
    if not run.finished(*trained):
        raw = with_input_position(scanned, SHIPMENT_ID)
        delays = delay.train_delay_model(clean_logistics(raw), SHIPMENT_ID, size=size)
        for name, df in zip(trained, (delays.scored, delays.metrics, delays.importance), strict=True):
            table(name, lambda df=df: df)


def _forecast_tables(
    run: versions.Run, table: Table, retail: DataFrame, keys: Sequence[str], size: ForestSize
) -> None:
    trained = ("model_forecast_comparison", "model_forecast_feature_importance")
    if not run.finished(*trained):
        fitted = demand.train_demand_model(retail, keys, size=size)
        for name, df in zip(trained, (fitted.comparison, fitted.importance), strict=True):
            table(name, lambda df=df: df)


def _kpi_tables(run: versions.Run, table: Table, retail: DataFrame, logistics: DataFrame) -> None:
    pairs = table(
        "bridge_perfect_order", lambda: bridge.build_bridge(retail, logistics, SHIPMENT_ID)
    )
    sold = run.scratch("retail_totals", lambda: kpis.retail_totals(retail))
    sent = run.scratch("logistics_totals", lambda: kpis.logistics_totals(logistics))
    builders = {
        "retail_kpi_daily": lambda: kpis.retail_kpi_daily(sold),
        "retail_kpi_monthly": lambda: kpis.retail_kpi_monthly(sold),
        "retail_monthly_overall": lambda: kpis.retail_monthly_overall(sold),
        "retail_category_summary": lambda: kpis.retail_category_summary(sold),
        "retail_promo_lift": lambda: kpis.retail_promo_lift(sold),
        "logistics_asset_kpi": lambda: kpis.logistics_asset_kpi(sent),
        "logistics_traffic_kpi": lambda: kpis.logistics_traffic_kpi(sent),
        "logistics_delay_reason_kpi": lambda: kpis.logistics_delay_reason_kpi(sent),
        "logistics_monthly_otd": lambda: kpis.logistics_monthly_otd(sent),
        "perfect_order_by_category": lambda: bridge.perfect_order_by_category(pairs),
    }
    for name, make in builders.items():
        table(name, make)
