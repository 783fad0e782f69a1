"""URL rules by a sort-merge range join on reversed hosts.

A host is written as its labels in reverse, each with a full stop after it, so
``www.example.com`` becomes ``com.example.www.``. A rule's host then covers the
interval of all keys that begin with its own key: from ``com.example.`` up to
``com.example/``, as ``/`` follows the full stop. Such intervals are nested or apart.
One sweep over the sorted keys of hosts and rules keeps, for each nesting depth,
the rule host that began last; those whose interval has not ended are the stack of
active rules. The paths of the active rules are compared at the end.

Only different hosts are swept, so a host with a third of all pages is one row.
The sweep runs in key ranges; each range begins with the stack that the ranges
before it have left, which is a table of one row per range.

Defined cases: a null url or one without ``://`` has an empty host and path and
gets the default verdict; repeated pages give repeated rows; of two rules with the
same host and path, ``block`` holds; no rules: every page gets the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.llm.common import attach
from orderflow.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE_SCHEMA = "verdict string, host string, path string"


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


def split_url(pages: DataFrame, page_id: str, url: str) -> DataFrame:
    """page_id, host and path of every page."""
    cut = F.locate("://", F.col(url))
    rest = F.when(cut > 0, F.substring(F.col(url), cut + 3, F.length(url))).otherwise(F.lit(""))
    return (
        pages.select(F.col(page_id).alias("page_id"), F.coalesce(rest, F.lit("")).alias("rest"))
        .withColumn("raw", F.regexp_extract("rest", "^[^/?#]*", 0))
        .withColumn("tail", F.substring(F.col("rest"), F.length("raw") + 1, F.length("rest")))
        .select(
            "page_id",
            F.translate("raw", UPPER, LOWER).alias("host"),
            F.regexp_extract("tail", "^[^?#]*", 0).alias("path"),
        )
    )


def host_key(host: str) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]")), "."), F.lit("."))


def active_rules(hosts: DataFrame, rules: DataFrame, ranges: int) -> DataFrame:
    """Every host with its stack of active rules: host, fitting."""
    starts = (
        rules.groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .groupBy("host")
        .agg(F.collect_list(F.struct("path", "verdict")).alias("paths"))
        .withColumn("key", host_key("host"))
        .withColumn("depth", F.size(F.split("host", "[.]")))
    )
    rule = F.struct(
        F.concat(F.expr("left(key, length(key) - 1)"), F.lit("/")).alias("until"),
        F.col("host").alias("host"),
        "paths",
    )
    events = starts.select("key", F.lit(0).alias("last"), "depth", rule.alias("rule"))
    points = hosts.select(
        host_key("host").alias("key"), F.lit(1).alias("last"), F.lit(0).alias("depth"),
        F.lit(None).cast(events.schema["rule"].dataType).alias("rule"), "host",
    )
    swept = stage(
        events.withColumn("host", F.lit(None).cast("string"))
        .unionByName(points)
        .repartitionByRange(ranges, "key")
        .withColumn("part", F.spark_partition_id()),
        "url-sweep",
    )
    depths = [r["depth"] for r in starts.select("depth").distinct().orderBy("depth").collect()]
    if not depths:
        return hosts.select("host", F.lit(None).cast(
            "array<struct<until:string,host:string,paths:array<struct<path:string,verdict:string>>>>"
        ).alias("fitting"))

    def begun(d: int) -> Column:
        return F.when(F.col("depth") == d, F.col("rule"))

    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    left = (
        swept.groupBy("part")
        .agg(*(F.max_by(begun(d), F.when(F.col("depth") == d, F.col("key"))).alias(f"end{d}")
               for d in depths))
        .select("part", *(F.last(f"end{d}", True).over(earlier).alias(f"from{d}") for d in depths))
    )
    sweep = (
        Window.partitionBy("part").orderBy("key", "last")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    stack = F.array(*(F.coalesce(F.last(begun(d), True).over(sweep), F.col(f"from{d}"))
                      for d in depths))
    return (
        # one row for each range
        swept.join(F.broadcast(left), "part")
        .withColumn("stack", stack)
        .where("last = 1")
        .select("host", F.expr("filter(stack, x -> x IS NOT NULL AND key < x.until)").alias("fitting"))
    )


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
          default: str = "allow", ranges: int | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every page.

    A rule fits its host and all subdomains where the page's path starts with the
    rule's path. The longest rule wins, measured on host and path together, then
    on the host. ``rules`` has the columns verdict, host and path.
    """
    spark = pages.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parsed = split_url(pages, page_id, url)
    hosts = stage(
        active_rules(parsed.select("host").distinct(),
                     rules.select("verdict", F.translate("host", UPPER, LOWER).alias("host"), "path"),
                     ranges),
        "url-hosts",
    )
    best = F.expr(
        """array_max(flatten(transform(fitting, r -> transform(
             filter(r.paths, p -> startswith(path, p.path)),
             p -> struct(length(r.host) + length(p.path) AS size, length(r.host) AS host_size,
                         concat(r.host, p.path) AS rule, p.verdict AS verdict)))))"""
    )
    return (
        attach(parsed, hosts, ["host"])
        .withColumn("best", best)
        .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    )
