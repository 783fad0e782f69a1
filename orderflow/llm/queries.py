"""Queries of the operators, as the entry file registers them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import (
    bagminhash,
    bpe,
    chat,
    decontaminate,
    lexical,
    license_scan,
    line_dedup,
    merkle,
    metric_join,
    phrases,
    sharding,
    toxicity,
    url_rules,
)
from orderflow.llm.common import documents

#: Fixed values of the url query: verdict, host, path.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir), shards=8)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", "text")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")


def op4_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.classes(documents(spark, sf_dir))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_with_next(documents(spark, sf_dir))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return url_rules.judge(pages, url_rules.rule_table(spark, URL_RULES))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    made = bpe.tokenizer_json(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.digest(docs.select("doc_id", "text"), made).drop("text")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(documents(spark, sf_dir))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


def op13_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {f.__name__: f for f in (
    op1_shards, op2_line_dedup, op3_toxicity, op4_bagminhash, op5_decontamination,
    op6_merkle, op7_url_filter, op8_license_scan, op9_chat_format, op10_byte_bpe,
    op11_lexical_search, op12_collocations, op13_metric_join)}
