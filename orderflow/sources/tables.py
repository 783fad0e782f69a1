"""Result tables: Parquet for every table, one CSV file for each small one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.sources import versions
from orderflow.sources.schemas import DETAIL_COLUMNS, heading

CSV = "csv"
#: The two row-level tables are laid out by month, which report filters prune.
PARTITIONED = {"retail_cleaned": "month", "logistics_cleaned": "month"}
#: Rows of one month lie in the order of these columns, so that the statistics of row groups
#: and pages let a filter on the first (or on the second, inside the first) skip most of them.
CLUSTERED = {
    "retail_cleaned": ("region", "category", "date"),
    "logistics_cleaned": ("asset_id", "ts"),
}
#: Bytes of a row group of these tables: small enough to skip, large enough to scan.
ROW_GROUP = 32 << 20
#: Tables exported in the order of a column: sort column, largest first.
SORTED_TABLES = {
    "retail_monthly_overall": ("month", False),
    "retail_category_summary": ("total_revenue", True),
    "retail_promo_lift": ("category", False),
    "logistics_asset_kpi": ("on_time_rate", False),
    "logistics_traffic_kpi": ("traffic_status", False),
    "logistics_delay_reason_kpi": ("share_of_delays_pct", True),
    "logistics_monthly_otd": ("month", False),
    "model_forecast_comparison": ("metric", False),
    "model_forecast_feature_importance": ("importance", True),
    "model_delay_metrics": ("metric", False),
    "model_delay_feature_importance": ("importance", True),
    "perfect_order_by_category": ("category", False),
}
#: Of these, the ones that grow with trucks or category values: their export has several
#: sorted files, each with a range of the sort column.
GROWING_TABLES = (
    "logistics_asset_kpi",
    "model_forecast_feature_importance",
    "model_delay_feature_importance",
)
#: Those with a row per month, category or metric are exported as a single CSV file.
SMALL_TABLES = tuple(t for t in SORTED_TABLES if t not in GROWING_TABLES)
#: Columns of the two row-level tables that report queries read.
REPORT_COLUMNS = {
    "retail_cleaned": ("date", "month", "region", "category", "revenue", "units_sold",
                       "stockout_occurred"),
    "logistics_cleaned": ("shipment_id", "month", "on_time_flag", *DETAIL_COLUMNS),
}
TABLES = (
    "retail_cleaned",
    "logistics_cleaned",
    "retail_kpi_daily",
    "retail_kpi_monthly",
    *SORTED_TABLES,
    "bridge_perfect_order",
)
#: Tables that the report reads; the daily and monthly KPI tables are exports only.
REPORT_TABLES = tuple(t for t in TABLES if t not in ("retail_kpi_daily", "retail_kpi_monthly"))


def write_table(df: DataFrame, out_dir: str, name: str, row_group: int = ROW_GROUP) -> None:
    """Replace one Parquet table.

    Row-level tables are rebalanced by month before the write: the adaptive
    planner merges small months and splits large ones, so neither tiny files nor
    one huge task per month result. Inside a month's files rows are clustered.
    """
    month = PARTITIONED.get(name)
    if month is not None:
        order = [c for c in CLUSTERED[name] if c in df.columns]
        # Static overwrite: months that a new run no longer has must go.
        (
            df.hint("rebalance", month)
            .sortWithinPartitions(month, *order)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("parquet.block.size", row_group)
            .partitionBy(month)
            .parquet(f"{out_dir}/{name}")
        )
    else:
        df.write.mode("overwrite").parquet(f"{out_dir}/{name}")


def export_csv(df: DataFrame, out_dir: str, name: str) -> None:
    """Write one table as CSV with its published headings; small ones as one file."""
    if name in SORTED_TABLES:
        column, descending = SORTED_TABLES[name]
        order = F.desc_nulls_last(column) if descending else F.asc_nulls_last(column)
        if name in SMALL_TABLES:
            df = df.repartition(1).sortWithinPartitions(order, df.columns[0])
        else:
            df = df.orderBy(order, df.columns[0])
    titled = df.toDF(*[heading(c) for c in df.columns])
    writer = titled.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.csv(f"{out_dir}/{CSV}/{name}")


def read_table(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """A table of the published version."""
    return spark.read.parquet(versions.table_path(spark, out_dir, name))


def read_report_tables(spark: SparkSession, out_dir: str) -> Mapping[str, DataFrame]:
    """The tables of the report, by name, all of one version."""
    manifest = versions.published(spark, out_dir)
    if manifest is not None:
        out_dir = f"{out_dir}/{versions.VERSIONS}/{manifest['version']}"
    return {name: spark.read.parquet(f"{out_dir}/{name}") for name in REPORT_TABLES}


def read_footers(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """A published table whose least and greatest values and row counts come from file footers.

    Spark pushes such aggregates into a scan of its newer reader only. It is chosen in a
    session of its own, which shares all but settings with ``spark``.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(versions.table_path(spark, out_dir, name))


class ReportTables(Mapping):
    """The report's tables, with what it reads of the row-level ones kept in memory.

    Use it as a context manager, or call :meth:`release`, to free the memory.
    """

    def __init__(self, tables: Mapping[str, DataFrame]):
        self._kept = {
            n: tables[n].select(*[c for c in columns if c in tables[n].columns]).cache()
            for n, columns in REPORT_COLUMNS.items()
            if n in tables
        }
        self._tables = {**tables, **self._kept}

    def __getitem__(self, name: str) -> DataFrame:
        return self._tables[name]

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def release(self) -> None:
        for df in self._kept.values():
            df.unpersist()

    def __enter__(self) -> ReportTables:
        return self

    def __exit__(self, *_) -> None:
        self.release()


class LiveTables:
    """The report's tables of the version that is published now.

    They are kept in memory between calls of :meth:`now` until a new version appears.
    """

    def __init__(self, spark: SparkSession, out_dir: str):
        self._spark, self._out_dir = spark, out_dir
        self._version: str | None = None
        self._tables: ReportTables | None = None

    def now(self) -> ReportTables:
        manifest = versions.published(self._spark, self._out_dir)
        version = manifest["version"] if manifest else None
        if self._tables is None or version != self._version:
            self.release()
            self._tables = keep_in_memory(read_report_tables(self._spark, self._out_dir))
            self._version = version
        return self._tables

    def release(self) -> None:
        if self._tables is not None:
            self._tables.release()
            self._tables = None


def keep_in_memory(tables: Mapping[str, DataFrame]) -> ReportTables:
    """Keep the row-level tables ready between report queries, until released."""
    return ReportTables(tables)
