"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A lookup table is broadcast up to this many rows; beyond, both sides are shuffled.
BROADCAST_ROWS = 100_000
#: Rows of one key are numbered in this many hash buckets.
NUMBER_BUCKETS = 512


#: Rows of text that a Python worker receives at once.
TEXT_ROWS = 1_000
_kept: dict = {}


def kept(owner, make):
    """State of one operator in a Python worker; that of another operator is given up first."""
    if owner not in _kept:
        _kept.clear()
        _kept[owner] = make()
    return _kept[owner]


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that sends ``TEXT_ROWS`` rows to Python at once: texts are long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_ROWS)
    return df


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def attach(
    big: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left",
    most: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join ``big`` with a staged ``lookup`` of narrow rows, one row per key.

    The lookup's rows are counted first. Up to ``most`` rows it is broadcast;
    a longer one takes a shuffled join, in which adaptive execution splits the
    partition of a hot key.
    """
    side = F.broadcast(lookup) if lookup.count() <= most else lookup
    return big.join(side, list(keys), how)


def number_within(df: DataFrame, key: str, order: Sequence[str], name: str,
                  buckets: int = NUMBER_BUCKETS) -> DataFrame:
    """Gapless numbers from 0 inside each ``key``, with no task for a whole key.

    Rows of a key fall into hash buckets of their order columns; a bucket starts
    where the ones before it end. Equal rows may swap numbers. Only the table of
    (key, bucket) counts is gathered by key, ``buckets`` rows for each.
    """
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(key, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(key, "_bucket").orderBy(*order)
    return (
        dealt.withColumn("_at", F.row_number().over(inside) - 1)
        .join(starts, [key, "_bucket"])
        .withColumn(name, (F.col("_start") + F.col("_at")).cast("long"))
        .drop("_bucket", "_at", "_start")
    )


def apart(df: DataFrame) -> DataFrame:
    """``df`` with columns of its own, to be grouped together with a table that it comes from."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def utf8_size(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
