"""Corpus pipeline: from ``documents`` to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before has
kept. Null texts count as empty, and empty ones are one class of near-duplicates; rows
without doc_id are never dropped by near-dedup; rows that repeat one doc_id are judged by
their own texts, and those that repeat the text too stay or go together; ``n_chars``
follows the text. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import bagminhash, decontaminate, line_dedup, toxicity
from orderflow.llm.common import documents
from orderflow.llm.queries import bpe_digests
from orderflow.session import delete, staged_path, staging_area

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.5."""
    model = toxicity.train_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where("score < 0.5").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the boilerplate lines of its source."""
    cut = line_dedup.drop_boilerplate(docs.select(*COLUMNS))
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id."""
    return bagminhash.one_of_each_class(docs).select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = decontaminate.mark_leaks(docs, benchmark)
    return marked.where(decontaminate.is_clean()).select(*COLUMNS)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded text."""
    return bpe_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("byte_bpe", to_tokens),
]
#: A trained model and sketches are no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. On disk stays only what it reads, the documents before it."""
    docs, before = documents(spark, sf_dir), None
    for name, step in STAGES[:-1]:
        path = staged_path(spark, f"pipeline-{name}")
        with staging_area(spark):  # what a stage stages for itself goes when it is written
            made = step(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before is not None:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
