"""CSV scans of the two inputs with declared types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from orderflow.sources.schemas import LOGISTICS, MISSING_TEXTS, RETAIL, column_name

#: Where a row was found: file, place of its block, and order of reading.
PLACES = ("_path", "_block", "_read")


def normalise_header(df: DataFrame) -> DataFrame:
    """Strip blanks around column names and bring them to snake case."""
    return df.toDF(*[column_name(c) for c in df.columns])


def typed(column: Column, data_type: T.DataType) -> Column:
    """Text to a typed value; every spelling of "missing" becomes NULL, never NaN.

    Anything else that does not parse fails under ANSI mode instead of turning
    into a silent gap.
    """
    text = F.when(~column.isin(*MISSING_TEXTS), column)
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, T.IntegerType):
        # A 0/1 column with gaps is often written as 0.0/1.0.
        number = text.cast("double")
        broken = F.raise_error(F.concat(F.lit("not a whole number: "), text))
        return F.when(number != F.floor(number), broken.cast("int")).otherwise(number.cast("int"))
    return text.cast(data_type)


def parse_columns(columns: Sequence[str]) -> tuple[list[str], T.StructType]:
    """Names, and the types of those given as ``name:type``."""
    pairs = [c.partition(":") for c in columns]
    typed_ones = ", ".join(f"{name} {kind}" for name, _, kind in pairs if kind)
    return [p[0] for p in pairs], T.StructType.fromDDL(typed_ones) if typed_ones else T.StructType()


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    extra: T.StructType | None = None,
    located: bool = False,
) -> DataFrame:
    """Scan by column name.

    Columns outside ``schema`` and ``extra`` pass through as text. ``located`` adds
    where each row was found, for :func:`with_input_position`.
    """
    raw = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .csv(path)
    )
    found = raw.select(
        "*", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()
    ) if located else raw
    named = found.toDF(*[column_name(c) for c in raw.columns], *(PLACES if located else ()))
    types = {f.name: f.dataType for f in [*schema.fields, *(extra.fields if extra else ())]}
    absent = [n for n in types if n not in named.columns]
    if absent:
        raise ValueError(f"{path}: missing columns {absent}")
    return named.select(
        *[
            F.col(c) if c in PLACES else typed(F.col(c), types.get(c, T.StringType())).alias(c)
            for c in named.columns
        ]
    )


def read_retail_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    return scan_csv(spark, path, RETAIL, **options)


def read_logistics_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    return scan_csv(spark, path, LOGISTICS, **options)


def with_input_position(df: DataFrame, name: str) -> DataFrame:
    """Key for rows that have none: their number in the order of files and lines.

    ``df`` is a staged scan with ``located``. Rows of one block of a file are read by
    one task in their order; a block starts where those before it end, by path and
    place. So the number depends on the files' names and rows alone, not on how the
    scan was split. The table of blocks has one row per block read.
    """
    places = [c for c in PLACES if c in df.columns]
    if name in df.columns:
        return df.withColumn(name, F.col(name).cast("bigint")).drop(*places)
    block = ["_path", "_block"]
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        df.groupBy(*block)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_read").alias("_first"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    )
    number = F.col("_start") + F.col("_read") - F.col("_first")
    numbered = df.join(blocks.drop("_n"), block).withColumn(name, number.cast("bigint"))
    return numbered.drop(*places, "_first", "_start")
