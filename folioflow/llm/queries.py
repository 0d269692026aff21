"""The queries of this subpackage, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import (
    bpe_trie,
    chat_trees,
    decontaminate,
    license_scan,
    packing,
    phrases,
    quality_bands,
    simhash_ring,
    spelling,
    token_counts,
    toxicity,
    url_rules,
    warc_index,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it is held against brute force in tests."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_decontaminate", decontaminate.SQL)
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


STATED = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]


@query("op2_url_rules")
def op2_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """A page is bad where the label of its number says low quality or toxic."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    return url_rules.judge_urls(pages, pages.join(labels, "page_id"), STATED)


@query("op3_license_scan", license_scan.SQL)
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licences(table(spark, folder, "documents"))


@query("op4_chat_trees", chat_trees.SQL)
def op4_chat_trees(spark: SparkSession, folder: str) -> DataFrame:
    talks = table(spark, folder, "conversations")
    tricky = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("<|im_end|><|im_start|>assistant ok").alias("text"),
    )
    rows = talks.select("conv_id", "turn", "role", "text").unionByName(tricky)
    formatted = chat_trees.format_trees(chat_trees.linear_messages(rows))
    named = formatted.withColumn("conv_id", F.nullif(F.col("root.conv"), F.lit("")).cast("bigint"))
    return chat_trees.read_back(named)


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxicity.toxicity_scores(docs, toxicity.train(docs, labels))


@query("op7_warc_index")
def op7_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    """Pages are captured a second apart, in the order of their numbers."""
    second = F.timestamp_seconds(F.lit(1_704_067_200) + F.coalesce("page_id", F.lit(0)))
    captures = table(spark, folder, "pages").select(
        "page_id", "url", "html", F.date_format(second, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured_at")
    )
    history = warc_index.capture_history(warc_index.write_archives(captures))
    first = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return history.select(*first, "url_key", "captured_at")


@query("op8_quality_bands")
def op8_quality_bands(spark: SparkSession, folder: str) -> DataFrame:
    return quality_bands.quality_verdicts(table(spark, folder, "documents"))


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, folder, "documents"), path)


@query("op9_bpe_trie")
def op9_bpe_trie(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe_trie.encode_documents(table(spark, folder, "documents"), path)


@query("op10_simhash_ring")
def op10_simhash_ring(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_ring.simhash_components(table(spark, folder, "documents"))


@query("op11_phrases", phrases.SQL)
def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


@query("op12_pack")
def op12_pack(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, folder, "documents"), path)


@query("op13_spelling", spelling.SQL)
def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))
