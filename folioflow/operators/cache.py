"""Reuse of extraction work by content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow import schemas

# The key format, and the tag that ages old entries out.
SCHEMA_TAG = "r1"
DEFAULT_FEATURES = ("FORMS",)


def cache_mode(forms_mode: bool, features: Sequence[str] = DEFAULT_FEATURES) -> str:
    return f"textract-{'-'.join(features)}" if forms_mode else "bda"


def cache_keys(
    files: DataFrame,
    forms_mode: bool = False,
    features: Sequence[str] = DEFAULT_FEATURES,
    content: str = "content",
) -> DataFrame:
    """Adds ``cache_key``: SHA-256 of the bytes under tag and mode.

    The file name has no part in it: a renamed copy has the same key.
    """
    return files.withColumn(
        "cache_key",
        F.concat(
            F.lit(f"extract-cache/{SCHEMA_TAG}/{cache_mode(forms_mode, features)}/"),
            F.sha2(F.col(content).cast("binary"), 256),
            F.lit(".json"),
        ),
    )


def cache_split(files: DataFrame, cache: DataFrame, use_cache: bool = True) -> tuple[DataFrame, DataFrame]:
    """(hits, misses) of keyed, classified files against (cache_key, entry).

    A hit serves the stored text under the current file name, keeps the stored
    extractor (or ``cache``) and is marked ``from_cache``. A corrupt entry is a
    miss. Text files never look, so a miss that is a text file keeps its ``content``;
    other misses have none, as what extracts them reads the file by its path. So only
    names and keys are shuffled, and a hot key is left to the adaptive skew join,
    since the cache side has one row per key.
    """
    names = [c for c in files.columns if c != "content"]
    looking = files.select(*names).filter(F.col("modality") != "text")
    if not use_cache:
        looking = looking.filter(F.lit(False))
    entries = cache.select("cache_key", F.from_json("entry", schemas.CACHE_ENTRY).alias("e")).filter(
        F.col("e.text").isNotNull()
    )
    hits = looking.join(entries, "cache_key").select(
        *[c for c in names if c != "modality"],
        F.coalesce("e.modality", "modality").alias("modality"),
        F.col("e.text").alias("text"),
        F.coalesce("e.extractor", F.lit("cache")).alias("extractor"),
        F.coalesce("e.metadata", F.expr("CAST(map() AS map<string,string>)")).alias("metadata"),
        F.lit(True).alias("from_cache"),
    )
    text_files = files.filter(F.col("modality") == "text")
    other = files.select(*names).filter(F.col("modality") != "text")
    if use_cache:
        other = other.join(entries.select("cache_key"), "cache_key", "left_anti")
    if "content" in files.columns:
        other = other.withColumn("content", F.lit(None).cast("binary"))
    return hits, text_files.unionByName(other)


def unique_work(misses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(work, fanout): one row to extract per key, and every name it serves.

    The row with the least path stands for its key. ``min_by`` combines before
    the shuffle, so a key that holds a third of the rows is no burden.
    """
    work = misses.groupBy("cache_key").agg(
        F.min_by("filename", "path").alias("filename"),
        F.min("path").alias("path"),
        F.count(F.lit(1)).alias("copies"),
    )
    return work, misses.select("cache_key", "path", "filename")


def fan_back(extracted: DataFrame, fanout: DataFrame) -> DataFrame:
    """Extracted texts, one per key, given to every name that waits for them."""
    return fanout.join(extracted.drop("path", "filename", "copies"), "cache_key")
