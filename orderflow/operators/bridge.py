"""Replenishment events paired with shipments, and the perfect order rate.

The two sources share no key. Each event draws one shipment at random, with
replacement: a disclosed simulation, not a join on real data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.functions.expr import HASH_BITS, flag, key_hash, percent, total, with_keys

SEED = 42
EVENT_KEY = ("month", "store_id", "product_id")
#: Shipments are numbered bucket by bucket; 2**16 buckets bound the bucket table.
BUCKET_BITS = 16
SHIPMENT_COLUMNS = (
    "asset_id",
    "shipment_status",
    "traffic_status",
    "waiting_time",
    "logistics_delay",
    "logistics_delay_reason",
    "on_time_flag",
    "delay_risk_score",
)


def replenishment_events(retail: DataFrame) -> DataFrame:
    """One event per month, store and product.

    Category and region change from row to row, so the event takes the most frequent value,
    the smallest one on a tie. Rows are first added up by event, category and region; modes
    and measures come from these sums. Each step combines on the map side, and none keeps
    a table of values for a group in memory.
    """
    sums = (
        with_keys(retail, *EVENT_KEY)
        .groupBy(*EVENT_KEY, "category", "region")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("units_ordered").alias("units_ordered"),
            F.max("stockout_occurred").alias("stockout_occurred"),
            F.max("stockout_risk").alias("stockout_risk"),
            F.sum("forecast_ape").alias("ape"),
            F.count("forecast_ape").alias("ape_rows"),
        )
    )
    attributes = ("category", "region")
    # one row for each attribute of a sum; the measures go with the first
    cells = [
        F.struct(
            F.lit(name).alias("attribute"),
            F.col(name).alias("value"),
            *[(F.col(c) if i == 0 else F.lit(None)).alias(c) for c in sums.columns if c not in (*EVENT_KEY, *attributes, "n")],
            F.col("n"),
        )
        for i, name in enumerate(attributes)
    ]
    counted = (
        sums.select(*EVENT_KEY, F.inline(F.array(*cells)))
        .groupBy(*EVENT_KEY, "attribute", "value")
        .agg(
            F.sum("n").alias("n"),
            F.sum("units_ordered").alias("units_ordered"),
            F.max("stockout_occurred").alias("stockout_occurred"),
            F.max("stockout_risk").alias("stockout_risk"),
            F.sum("ape").alias("ape"),
            F.sum("ape_rows").alias("ape_rows"),
        )
    )

    def most_frequent(name: str) -> Column:
        known = (F.col("attribute") == name) & F.col("value").isNotNull()
        return F.min(F.when(known, F.struct(-F.col("n"), "value")))["value"].alias(name)

    return counted.groupBy(*EVENT_KEY).agg(
        most_frequent("category"),
        most_frequent("region"),
        total("units_ordered").alias("units_ordered"),
        F.max("stockout_occurred").alias("stockout_occurred"),
        F.max("stockout_risk").alias("stockout_risk"),
        F.try_divide(F.sum("ape"), F.sum("ape_rows")).alias("forecast_ape"),
    )


def number_rows(df: DataFrame, key: str, name: str, seed: int = SEED) -> DataFrame:
    """Dense numbers 0..n-1 in the order of the hashed key, without a global sort.

    The leading hash bits split the rows into buckets of near equal size, whatever
    the data look like. Rows are ranked inside their bucket; each bucket starts
    where the ones before it end. The bucket table has at most 2**16 rows, which
    bounds its running total and its broadcast.
    """
    hashed = df.withColumn("_hash", key_hash(seed, key)).withColumn(
        "_bucket", F.shiftright("_hash", HASH_BITS - BUCKET_BITS)
    )
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    in_bucket = Window.partitionBy("_bucket").orderBy("_hash", key)
    return (
        hashed.join(F.broadcast(starts), "_bucket")
        .withColumn(name, F.col("_start") + F.row_number().over(in_bucket) - 1)
        .drop("_hash", "_bucket", "_start")
    )


#: Rows of a group are numbered in 2**10 buckets.
GROUP_BITS = 10


def hash_bucket(seed: int, *keys: str, bits: int = GROUP_BITS) -> Column:
    """Even buckets of the hashed keys, in the order of the hash."""
    return F.shiftright(key_hash(seed, *keys), HASH_BITS - bits)


def number_within(
    df: DataFrame, group: str, keys: Sequence[str], name: str, seed: int = SEED, bits: int = GROUP_BITS
) -> DataFrame:
    """Dense numbers 0..n-1 inside each ``group`` value, in the order of the hashed keys.

    As :func:`number_rows`, with 2**bits buckets for each value; missing values are
    one group. The running totals are over one row per value and bucket.
    """
    hashed = df.withColumn("_hash", key_hash(seed, group, *keys)).withColumn(
        "_bucket", F.shiftright("_hash", HASH_BITS - bits)
    )
    before = (
        Window.partitionBy("_group").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        hashed.groupBy(F.col(group).alias("_group"), F.col("_bucket").alias("_at"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_group", "_at", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    in_bucket = Window.partitionBy(group, "_bucket").orderBy("_hash", *keys)
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bucket") == F.col("_at"))
    return (
        hashed.withColumn("_rank", F.row_number().over(in_bucket) - 1)
        .join(starts, same)
        .withColumn(name, F.col("_start") + F.col("_rank"))
        .drop("_hash", "_bucket", "_rank", "_group", "_at", "_start")
    )


def build_bridge(
    retail: DataFrame, logistics: DataFrame, shipment_key: str = "shipment_id", seed: int = SEED
) -> DataFrame:
    """Every event with the shipment it draws.

    The draw depends on the event key only. Draws and shipment numbers are both
    spread evenly, so the join has no hot key; Catalyst picks its strategy.
    """
    columns = [c for c in SHIPMENT_COLUMNS if c in logistics.columns]
    shipments = number_rows(logistics.select(shipment_key, *columns), shipment_key, "draw", seed)
    shipment_count = F.greatest(logistics.agg(F.count(F.lit(1))).scalar(), F.lit(1))
    draw = F.pmod(key_hash(seed, *EVENT_KEY), shipment_count)
    return (
        replenishment_events(retail)
        # A draw that cannot be NULL keeps Catalyst from testing it on every retail row.
        .withColumn("draw", F.coalesce(draw, F.lit(0).cast("bigint")))
        .join(shipments, "draw")
        .drop("draw")
        .withColumnRenamed("on_time_flag", "delivered_on_time")
        .withColumn(
            "perfect_order",
            flag((F.col("stockout_occurred") == 0) & (F.col("delivered_on_time") == 1)),
        )
    )


def perfect_order_by_category(bridge: DataFrame) -> DataFrame:
    return (
        with_keys(bridge, "category")
        .groupBy("category")
        .agg(
            F.count("perfect_order").alias("replenishment_events"),
            percent(F.avg("perfect_order")).alias("perfect_order_rate"),
            percent(1 - F.avg("stockout_occurred")).alias("stockout_free_rate"),
            percent(F.avg("delivered_on_time")).alias("on_time_rate"),
        )
    )
