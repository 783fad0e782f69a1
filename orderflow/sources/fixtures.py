"""Star-schema tables shaped into the ``retail`` and ``logistics`` sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns that make the row order inside one series and day unique.
TIE_BREAKERS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
#: Row key of a retail fixture row.
ROW_KEY = ("store_id", "product_id", "date", *TIE_BREAKERS)


# Column types of the star-schema tables. Declared types save one
# footer-reading job per table.
TABLE_TYPES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_TYPES[name]).parquet(f"{sf_dir}/{name}.parquet")


def fixture_rows(spark: SparkSession, sf_dir: str) -> int:
    """Upper bound of the retail rows, read from the Parquet footers."""
    return _table(spark, sf_dir, "lineitem").count()


def retail_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line.

    Small tables are joined as base tables, so Catalyst compares true file sizes with
    the broadcast limit. Orders with their buyers are a derived table of estimated
    size; the line items meet it in a shuffled join, which is right for large inputs.
    """
    store, buyer = F.col("store_nation.n_regionkey"), F.col("buyer_nation.n_regionkey")
    nation = _table(spark, sf_dir, "nation")
    orders = (
        _table(spark, sf_dir, "orders")
        .join(_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation.alias("buyer_nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_table(spark, sf_dir, "region"), buyer == F.col("r_regionkey"))
        .select("o_orderkey", "o_orderpriority", F.col("r_name").alias("region"))
    )
    rows = (
        _table(spark, sf_dir, "lineitem")
        .join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(_table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation.alias("store_nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("store_id", F.concat(F.lit("S00"), store + 1))
    )
    month = F.month("l_shipdate")
    return rows.select(
        F.to_date("l_shipdate").alias("date"),
        "store_id",
        F.col("p_brand").alias("product_id"),
        F.col("p_type").alias("category"),
        "region",
        F.when(F.col("l_orderkey") % 101 == 0, F.lit(None))
        .otherwise((F.col("p_size") + 20).cast("double"))
        .alias("inventory_level"),
        F.when(F.col("l_orderkey") % 97 == 0, F.lit(0.0))
        .otherwise(F.col("l_quantity"))
        .alias("units_sold"),
        (F.col("l_quantity") + F.col("l_linenumber")).alias("units_ordered"),
        (F.col("l_quantity") * (F.lit(0.96) + F.col("l_tax"))).alias("demand_forecast"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        (F.col("l_discount") * 100.0).alias("discount"),
        F.when(F.col("l_returnflag") == "A", "Sunny")
        .when(F.col("l_returnflag") == "N", "Rainy")
        .when(F.col("l_returnflag") == "R", "Cloudy")
        .alias("weather_condition"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1)
        .otherwise(0)
        .alias("holiday_promotion"),
        (F.col("p_retailprice") * 1.25).alias("competitor_pricing"),
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.between(3, 5), "Spring")
        .when(month.between(6, 8), "Summer")
        .otherwise("Autumn")
        .alias("seasonality"),
        *TIE_BREAKERS,
    )


def logistics_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    delayed = (key % 3 == 2) | ((key * 7 + cust) % 100 < 35)
    return _table(spark, sf_dir, "orders").select(
        key.alias("shipment_id"),
        F.timestamp_add("HOUR", (key % 24).cast("int"), F.col("o_orderdate")).alias("ts"),
        F.concat(F.lit("Truck_"), cust % 10 + 1).alias("asset_id"),
        F.when(F.col("o_orderstatus") == "F", "Delivered")
        .when(F.col("o_orderstatus") == "O", "In Transit")
        .otherwise("Delayed")
        .alias("shipment_status"),
        F.when(key % 3 == 0, "Clear").when(key % 3 == 1, "Detour").otherwise("Heavy")
        .alias("traffic_status"),
        (key % 61).cast("double").alias("waiting_time"),
        (F.lit(60.0) + cust % 41).alias("asset_utilization"),
        F.when(delayed, 1).otherwise(0).alias("logistics_delay"),
        F.when(cust % 4 == 1, "Weather")
        .when(cust % 4 == 2, "Traffic")
        .when(cust % 4 == 3, "Mechanical Failure")
        .alias("logistics_delay_reason"),
        (F.lit(18.0) + (key % 130) / 10.0).alias("temperature"),
        (F.lit(50.0) + (key % 300) / 10.0).alias("humidity"),
        (F.col("o_totalprice") / 1000.0).alias("user_transaction_amount"),
        (F.lit(1.0) + cust % 10).alias("user_purchase_frequency"),
        (F.lit(100.0) + key % 401).alias("inventory_level"),
    )
