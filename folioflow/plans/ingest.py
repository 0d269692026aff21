"""A file's way from upload to index, as one job over a table of files.

Classify, key, look in the cache, choose an extractor, read, redact, gate, and
only then the two writes: cache and published documents. Without anything that finds
names the job does not start, as long as names are to be redacted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.pii import RedactionSettings
from folioflow.operators import cache, classify, redact
from folioflow.session import new_run_folder
from folioflow.sources import sinks

NO_METADATA = "CAST(map() AS map<string,string>)"
NO_RESULT = "there is no extraction result for this file"


@dataclass
class Ingested:
    """What one run made: documents ready to write, and what was turned away.

    ``extracted`` has a row (cache_key) for each extraction that was used, so none
    where all was served from the cache.
    """

    documents: DataFrame
    from_cache: DataFrame
    rejects: DataFrame
    extracted: DataFrame
    mode: str
    check: Callable[[DataFrame], None]


def ingest_files(
    files: DataFrame,
    extracted: DataFrame,
    cached: DataFrame,
    settings: RedactionSettings = RedactionSettings(),
    forms_mode: bool = False,
    use_cache: bool = True,
    names: DataFrame | None = None,
    finder: Callable[[], redact.Finder] | None = None,
) -> Ingested:
    """Plan of a run over (path, filename, content).

    ``extracted`` (cache_key, text) holds what the extraction services made of
    the keys they were given; text files are decoded here. A file that has no
    result, and is no text, is a reject. Only text files keep their content behind
    the cache, and it is decoded in the row. Names are redacted by ``names(name)`` or
    a ``finder``; with neither, and ``PERSON`` among the entities, nothing is planned.
    """
    if settings.enabled and redact.names_missing(settings, names, finder, None):
        raise redact.RedactionUnavailable("redaction is on but nothing can find names")
    classified, unreadable = classify.classify_files(files)
    keyed = cache.cache_keys(classified, forms_mode)
    hits, misses = cache.cache_split(keyed, cached, use_cache)
    routed = classify.route_extractor(misses, forms_mode)
    refused = routed.filter(F.col("reason").isNotNull()).select("filename", "reason")
    ready = routed.filter(F.col("reason").isNull()).drop("reason")
    plain = classify.decode_plaintext(ready).select(
        "cache_key", "path", "filename", "modality", "extractor", "text"
    )
    waiting = ready.filter(F.col("modality") != "text").drop("content")
    work, fanout = cache.unique_work(waiting)
    read = extracted.join(work.select("cache_key"), "cache_key", "left_semi")
    unread = fanout.join(extracted.select("cache_key"), "cache_key", "left_anti")
    others = cache.fan_back(read.select("cache_key", "text"), fanout).join(
        waiting.select("path", "modality", "extractor"), "path"
    )
    documents = plain.unionByName(others.select(*plain.columns)).withColumn(
        "metadata", F.expr(NO_METADATA)
    )
    redacted = redact.redact_text(documents, settings, names=names, finder=finder)
    counted = F.map_concat(
        "metadata", F.create_map(F.lit("pii_redacted"), F.to_json("entity_counts"))
    )
    gated = redact.redaction_gate(
        redacted.withColumn(
            "metadata", F.when(F.size("entity_counts") > 0, counted).otherwise(F.col("metadata"))
        ).withColumn("doc_key", F.col("path")),
        settings,
        names,
        finder=finder,
    )
    rejects = unreadable.select("filename", "reason").unionByName(refused)
    return Ingested(
        gated,
        hits,
        rejects.unionByName(unread.select("filename", F.concat("filename", F.lit(": " + NO_RESULT)).alias("reason"))),
        read.select("cache_key"),
        cache.cache_mode(forms_mode),
        redact.check_staged(settings, names, finder=finder),
    )


def store(run: Ingested, cache_path: str, publish_path: str, batch: str | None = None) -> DataFrame:
    """Write a run: cache entries of what was extracted, then documents of all.

    The redacted rows are written once to the shared folder, as both writes read
    them. Documents are staged, checked and then published. Cache entries are kept
    under the mode of the run. Returns the rejects of both steps.
    """
    staged = new_run_folder(run.documents.sparkSession, "ingest")
    run.documents.write.parquet(staged)
    documents = run.documents.sparkSession.read.schema(run.documents.schema).parquet(staged)
    columns = ["filename", "modality", "extractor", "text"]
    everything = documents.select(*columns).unionByName(run.from_cache.select(*columns))
    rejects = run.rejects.unionByName(sinks.publish_documents(everything, publish_path, batch, run.check))
    sinks.cache_store(documents.filter(F.col("modality") != "text"), cache_path, run.mode)
    return rejects
