"""Writing cache entries and documents. Parquet, appended, keyed by content."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow import schemas
from folioflow.functions.keys import one_per_key
from folioflow.functions.text import is_blank
from folioflow.operators.cache import SCHEMA_TAG, cache_mode
from folioflow.session import new_run_folder
from folioflow.sources import ledger

EMPTY_TEXT = "extraction produced no text; nothing to index."


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or no rows where nothing was written yet."""
    return spark.read.schema(schema).parquet(path) if ledger.exists(spark, path) else spark.createDataFrame([], schema)


def new_cache_entries(documents: DataFrame, cache: DataFrame) -> DataFrame:
    """Entries (cache_key, entry) that the cache does not hold yet.

    One per key, the least entry where copies differ; blank texts are skipped.
    """
    entry = F.to_json(F.struct("text", "modality", "extractor", "metadata"))
    entries = documents.filter(~is_blank(F.col("text"))).select("cache_key", entry.alias("entry"))
    return one_per_key(entries, "cache_key", [F.col("entry")], cache)


def cache_store(documents: DataFrame, path: str, mode: str = cache_mode(False)) -> DataFrame:
    """Append new entries to the cache table at ``path``; returns the table.

    Partitioned by schema tag and mode, so a lookup reads one partition and a
    new tag leaves old entries unread.
    """
    spark = documents.sparkSession
    held = read_or_empty(spark, path, schemas.CACHE).filter(
        (F.col("schema_tag") == SCHEMA_TAG) & (F.col("mode") == mode)
    )
    (
        new_cache_entries(documents, held)
        .withColumns({"schema_tag": F.lit(SCHEMA_TAG), "mode": F.lit(mode)})
        .write.mode("append")
        .partitionBy("schema_tag", "mode")
        .parquet(path)
    )
    return read_or_empty(spark, path, schemas.CACHE)


PUBLISHED = "doc_key STRING, text STRING, source_filename STRING, extractor STRING, source_modality STRING"


def split_publishable(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to publish, rejects) of redacted documents.

    The published key is a hash of name and text, so the same file twice is one
    row; the reference adds a random part and indexes it twice.
    """
    blank = is_blank(F.col("text"))
    published = documents.filter(~blank).select(
        F.sha2(F.concat_ws("\u0000", "filename", "text"), 256).alias("doc_key"),
        "text",
        F.col("filename").alias("source_filename"),
        "extractor",
        F.col("modality").alias("source_modality"),
    )
    rejects = documents.filter(blank).select(
        "filename", F.concat(F.col("filename"), F.lit(": " + EMPTY_TEXT)).alias("reason")
    )
    return published, rejects


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The documents of all batches that count."""
    return ledger.read(spark, path, PUBLISHED).drop("batch")


def publish_documents(
    documents: DataFrame,
    path: str,
    batch: str | None = None,
    check: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Publish what is new at ``path``; returns the rejects.

    In two steps. Rows are staged in the batch's own folder, and ``check`` looks at
    the staged files and raises if they must not be seen. Then the batch's record is
    put in the ledger, and with it all its rows count. What fails before that leaves
    the published table as it was; a ``batch`` that counts already is not written
    again, and one that failed replaces what it had staged.
    """
    spark = documents.sparkSession
    published, rejects = split_publishable(documents)
    batch = batch or uuid.uuid4().hex
    if batch in ledger.committed(spark, path):
        return rejects
    # Written first, as the rows are looked at more than once and are costly to make.
    draft = new_run_folder(spark, "publish")
    published.write.parquet(draft)
    published = spark.read.schema(PUBLISHED).parquet(draft)
    order = [F.coalesce(F.col(c), F.lit("")) for c in ("extractor", "source_modality")]
    fresh = one_per_key(published, "doc_key", order, read_published(spark, path))
    staged = ledger.batch_folder(path, batch)
    fresh.write.mode("overwrite").partitionBy("source_modality").parquet(staged)
    rows = spark.read.schema(PUBLISHED).parquet(staged)
    if check is not None:
        try:
            check(rows)
        except Exception:
            ledger.remove(spark, staged)
            raise
    ledger.commit(spark, path, batch, rows=rows.count())
    return rejects


def publish_each(path: str, name: str, check=None) -> Callable[[DataFrame, int], None]:
    """What ``foreachBatch`` calls: a batch that is run again leaves one copy.

    ``name`` tells the stream from others that publish at the same path; it stays
    the same when the stream starts again from its checkpoint.
    """

    def each(batch: DataFrame, number: int) -> None:
        publish_documents(batch, path, f"{name}-{number}", check)

    return each
