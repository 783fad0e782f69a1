"""Line deduplication by frequency within a site.

The pages of a host that contain a line, divided by all pages of that host, is the
line's ratio. Lines above the boilerplate ratio are dropped from the host's pages.

Lines are compared without blanks at their ends, by their MD5. Each page counts a
line once. Counting shuffles one short row per page and line, added up before the
shuffle. A host has at most (lines per page / ratio) boilerplate lines, so their
list is short whatever the host's size; it is joined to the pages by host.

Defined cases: blank lines are never dropped; a page without host belongs to no
site and keeps its text; null text stays null; a page that loses all lines keeps an
empty text; repeated rows count as pages of their own; rows are never dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import attach
from orderflow.session import stage

#: A line on more than this share of a host's pages is boilerplate ...
RATIO = 0.1
#: ... if at least this many of its pages have it.
MIN_PAGES = 5


def boilerplate(pages: DataFrame, host: str = "source", text: str = "text",
                ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Boilerplate lines of every host: host, line_md5, pages, host_pages."""
    own = pages.select(F.col(host).alias("host"), F.col(text).alias("text")).where("host IS NOT NULL")
    lines = own.select("host", F.explode(F.expr(
        "array_distinct(transform(split(text, '\\n'), x -> trim(x)))")).alias("line"))
    counts = (
        lines.where("line != ''")
        .groupBy("host", F.md5("line").alias("line_md5"))
        .agg(F.count(F.lit(1)).alias("pages"))
        .where(F.col("pages") >= min_pages)
    )
    totals = own.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    return counts.join(totals, "host").where(F.col("pages") / F.col("host_pages") > ratio)


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text",
                     ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` with ``text`` cut, and the counts ``n_lines`` and ``n_dropped``."""
    lists = stage(
        boilerplate(pages, host, text, ratio, min_pages)
        .groupBy("host").agg(F.collect_list("line_md5").alias("_boilerplate")),
        "boilerplate",
    )
    kept = [c for c in pages.columns if c not in (text, "n_lines", "n_dropped")]
    page = pages.select(
        F.struct(*kept).alias("_page"), F.col(host).alias("host"), F.split(text, "\n").alias("_lines"),
    )
    cut = F.expr("""CASE WHEN _boilerplate IS NULL THEN _lines ELSE
        filter(_lines, x -> trim(x) = '' OR NOT array_contains(_boilerplate, md5(trim(x)))) END""")
    return (
        attach(page, lists, ["host"], most=10_000)
        .withColumn("_left", cut)
        .select(
            *(F.col("_page")[c].alias(c) for c in kept),
            F.array_join("_left", "\n").alias(text),
            F.coalesce(F.size("_lines"), F.lit(0)).alias("n_lines"),
            F.coalesce(F.size("_lines") - F.size("_left"), F.lit(0)).alias("n_dropped"),
        )
    )
