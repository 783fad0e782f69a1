"""Document fingerprints: a Merkle tree over paragraphs and sections.

A text is cut into pieces, each up to and including its run of full stops, question
or exclamation marks or line ends: the lines, and in them the sentences of long
paragraphs. A piece's hash is a leaf. A leaf that begins with 0 or 1 ends a section,
so sections follow the content (eight leaves on average) and an edit moves no later
border. A section hashes its leaves, the root hashes the sections:

    root:section(leaf,leaf)section(leaf,leaf,leaf)

Roots test equality; sections, then leaves, that differ locate an edit. All of it
is built-in functions.

The order of documents is that of doc_id. Rows meet their neighbours in groups of
ids with the same leading bits; each group also gets the first row of the next one
as a guest. So a text is shuffled once, and no task sorts more than a group.

Defined cases: null text is empty text, which has a tree without leaves; two empty
trees are alike (1.0), an empty and another not (0.0); rows of one doc_id follow in
the order of their text; a row without doc_id comes last, has no next document, and
is compared as if an empty text followed; a single row is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.llm.common import attach
from orderflow.session import stage

PIECES = r"[^.!?\n]*[.!?\n]+|[^.!?\n]+"
#: Bits of doc_id inside a group of neighbours.
GROUP_BITS = 10


def leaves(text: str) -> Column:
    """The leaf hashes of a text, in its order."""
    pieces = F.regexp_extract_all(F.col(text), F.lit(PIECES), F.lit(0))
    return F.transform(pieces, lambda x: F.left(F.sha2(x, 256), F.lit(16)))


def fingerprint(leaf_column: str) -> Column:
    """Root, sections and leaves as one text."""
    marked = F.expr(
        f"array_join(transform({leaf_column}, x -> concat(x, CASE WHEN left(x, 1) IN ('0', '1') "
        "THEN ';' ELSE ',' END)), '')"
    )
    sections = F.filter(F.split(marked, ";"), lambda s: s != "")
    nodes = F.transform(
        F.transform(sections, lambda s: F.rtrim(s, F.lit(","))),
        lambda s: F.struct(F.left(F.sha2(s, 256), F.lit(32)).alias("hash"), s.alias("own")),
    )
    return F.transform(F.array(nodes), lambda n: F.concat(
        F.sha2(F.array_join(n["hash"], ""), 256), F.lit(":"),
        F.array_join(F.transform(n, lambda s: F.concat(s["hash"], F.lit("("), s["own"], F.lit(")"))), ""),
    ))[0]


def likeness(a: str, b: str) -> Column:
    """Dice coefficient of the different leaves of two trees."""
    size = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    both = F.size(F.array_intersect(a, b))
    return F.when(size == 0, F.lit(1.0)).otherwise(2.0 * both / size)


def differing(a: str, b: str) -> Column:
    """Leaves of fingerprint ``a`` in sections that ``b`` lacks, where ``b`` lacks the leaf too."""
    section, leaf = "'[0-9a-f]{32}[(][^)]*[)]'", "'[0-9a-f]{16}(?=[,)])'"
    return F.expr(
        f"""array_except(flatten(transform(
              array_except(regexp_extract_all({a}, {section}, 0), regexp_extract_all({b}, {section}, 0)),
              s -> regexp_extract_all(s, {leaf}, 0))),
            regexp_extract_all({b}, {leaf}, 0))"""
    )


def _group(key: Column, bits: int = GROUP_BITS) -> Column:
    return F.shiftright(key, bits)


def first_of_next(ids: DataFrame, bits: int = GROUP_BITS) -> DataFrame:
    """For each group of ids (column doc_id): grp, and next_id, the first id after the group.

    The last group is followed by the first id of all. Groups are sorted in ranges and
    chained inside them; only the first id of each range is sorted in one task, as many as
    the sort has tasks, however the ids are spread.
    """
    groups = stage(
        ids.groupBy(_group(F.col("doc_id"), bits).alias("grp"))
        .agg(F.min("doc_id").alias("first_id"))
        .orderBy("grp")
        .withColumn("range", F.spark_partition_id()),
        "id-groups",
    )
    ranges = groups.groupBy("range").agg(F.min("first_id").alias("range_first"))
    chain = Window.orderBy("range")
    ranges = ranges.withColumn("after", F.coalesce(
        F.lead("range_first").over(chain), F.min("range_first").over(Window.partitionBy(F.lit(1)))))
    inside = Window.partitionBy("range").orderBy("grp")
    return (
        groups.withColumn("within", F.lead("first_id").over(inside))
        .join(F.broadcast(ranges), "range")
        .select("grp", F.coalesce("within", "after").alias("next_id"))
    )


def with_next(docs: DataFrame, bits: int = GROUP_BITS) -> DataFrame:
    """doc_id, text, next_text of every row."""
    own = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = own.where("doc_id IS NOT NULL")
    following = stage(first_of_next(keyed.select("doc_id"), bits), "id-next")
    guests = attach(
        keyed.withColumnRenamed("doc_id", "next_id"), following, ["next_id"], "inner"
    ).select(F.col("next_id").alias("doc_id"), "text", "grp", F.lit(True).alias("guest"))
    rows = keyed.withColumn("grp", _group(F.col("doc_id"), bits)).withColumn("guest", F.lit(False))
    order = Window.partitionBy("grp").orderBy("guest", "doc_id", "text")
    return (
        rows.unionByName(guests)
        .withColumn("next_text", F.lead("text").over(order))
        .where("NOT guest")
        .select("doc_id", "text", "next_text")
        .unionByName(own.where("doc_id IS NULL").withColumn("next_text", F.lit("")))
    )


def compare_with_next(docs: DataFrame, bits: int = GROUP_BITS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, gone.

    ``gone`` locates the edit: the leaves that only the text's tree has, sorted.
    """
    half = F.expr("n_chars div 2")
    return (
        with_next(docs, bits)
        .withColumn("n_chars", F.char_length("text").cast("long"))
        .withColumn("edited", F.concat(
            F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")),
            F.substring(F.col("next_text"), F.lit(1), half.cast("int"))))
        .select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                leaves("text").alias("own"), leaves("edited").alias("changed"),
                leaves("next_text").alias("following"))
        .select("doc_id", "n_chars", "edited_sha256",
                fingerprint("own").alias("fingerprint"),
                fingerprint("changed").alias("edited_fingerprint"),
                likeness("own", "changed").alias("near_edited"),
                likeness("own", "following").alias("near_next"))
        .withColumn("gone", F.array_join(
            F.array_sort(differing("fingerprint", "edited_fingerprint")), ","))
    )
