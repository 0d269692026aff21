"""Inputs of the registered queries, derived by Spark from the given tables.

Where the tables have no column of the needed shape (no JSON results, no form
blocks), one is built here from their own texts and numbers, over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators import cache

SUFFIXES = ".txt .pdf .png .mp3 .mp4 .xlsx .docx .csv .md .jpg .wav .zip".split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def filename(doc_id: Column) -> Column:
    ending = F.element_at(
        F.array(*[F.lit(s) for s in SUFFIXES]), (doc_id % len(SUFFIXES)).cast("int") + 1
    )
    return F.concat(F.lit("doc_"), doc_id.cast("string"), ending)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_key BIGINT, text, lang, source)."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("doc_key"), "text", "lang", "source"
    )


def files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_key, path, filename, content): every document as an upload."""
    name = filename(F.col("doc_key"))
    return documents(spark, folder).select(
        "doc_key",
        F.concat(F.lit("uploads/"), name).alias("path"),
        name.alias("filename"),
        F.col("text").cast("binary").alias("content"),
        "lang",
    )


def questions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text")


def cached_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Entries for the documents that have labels; toxic ones are corrupt."""
    keyed = cache.cache_keys(files(spark, folder)).select("doc_key", "cache_key", F.col("content").cast("string").alias("text"))
    labelled = keyed.join(
        table(spark, folder, "labels").withColumnRenamed("doc_id", "doc_key"), "doc_key"
    )
    first = labelled.groupBy("cache_key").agg(
        F.min_by(F.struct("text", "quality", "toxic"), "doc_key").alias("d")
    )
    entry = F.to_json(
        F.struct(
            F.concat(F.lit("stored: "), "d.text").alias("text"),
            F.when(F.col("d.quality") == 1, "vision").alias("extractor"),
        )
    )
    return first.select(
        "cache_key", F.when(F.col("d.toxic") == 1, F.lit('{"text": ')).otherwise(entry).alias("entry")
    )


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """A job per document: each line is an asset, and its words are segments;
    words of three letters or fewer have no path."""
    lines = F.split("text", "\n")
    assets = F.transform(
        lines,
        lambda line: F.struct(
            F.transform(
                F.split(line, " "),
                lambda word: F.struct(
                    F.when(F.length(word) > 3, F.concat(F.lit("out/"), word, F.lit(".json")))
                    .otherwise("")
                    .alias("standard_output_path")
                ),
            ).alias("segment_metadata")
        ),
    )
    return documents(spark, folder).select(
        F.col("doc_key").alias("job_id"),
        F.to_json(
            F.struct(assets.alias("output_metadata"), F.upper("lang").alias("semantic_modality"))
        ).alias("manifest_json"),
    )


def extraction_results(spark: SparkSession, folder: str) -> DataFrame:
    """A result per document, built from its lines: the first is a transcript,
    all are pages (markdown when long), and the rest is an image."""
    lines = F.split("text", "\n")
    shown = lambda text: F.struct(F.struct(F.struct(text.alias("text")).alias("representation")).alias("transcript"))
    pages = F.transform(
        lines,
        lambda line: F.struct(
            F.struct(
                F.when(F.length(line) > 80, F.concat(F.lit("## "), line)).otherwise("").alias("markdown"),
                line.alias("text"),
            ).alias("representation")
        ),
    )
    segment = F.struct(
        F.when(F.col("lang") != "en", shown(F.get(lines, F.lit(0)))).alias("audio"),
        F.when(F.col("lang") == "es", shown(F.col("source"))).alias("video"),
        F.array(F.struct(F.lit("  ").alias("summary")), F.struct(F.col("lang").alias("summary"))).alias("chapters"),
        pages.alias("pages"),
        F.struct(
            F.col("source").alias("summary"),
            F.array(F.struct(F.concat(F.lit(" "), "lang", F.lit(" ")).alias("text"))).alias("text_lines"),
        ).alias("image"),
    )
    last = F.lit('{"pages": [{"representation": {"text": "end"}}]}')
    return documents(spark, folder).select(
        "doc_key",
        F.concat(F.lit("["), F.to_json(segment), F.lit(", "), last, F.lit("]")).alias("segments_json"),
    )


def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select(
        "doc_key", F.posexplode(F.split("text", "\n")).alias("page_no", "text")
    )


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as turns: one session and one actor each."""
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("actor_id"),
        F.col("conv_id").alias("session_id"),
        F.col("turn").alias("seq"),
        (
            F.lit("2024-01-01 00:00:00").cast("timestamp")
            + F.make_dt_interval(F.lit(0), F.col("conv_id"), F.col("turn"))
        ).alias("ts"),
        "role",
        "text",
    )


def form_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """A form per conversation. Each turn is a line, and a field whose key is
    the role and whose value is the text, word by word; a user's field starts
    with a selected box, others with one that is not."""
    t = turns(spark, folder).select(
        F.col("session_id").alias("doc_key"), "seq", "role", "text", F.split("text", r"\s+").alias("w")
    )
    seq = F.col("seq").cast("string")
    block = lambda pos, id, kind, text=None, rel=None, ent=None, sel=None: F.struct(
        (F.col("seq") * 10 + pos).cast("int").alias("pos"),
        id.alias("id"),
        F.lit(kind).alias("block_type"),
        (text if text is not None else F.lit(None).cast("string")).alias("text"),
        (rel if rel is not None else F.expr("CAST(NULL AS array<struct<type:string,ids:array<string>>>)")).alias("relationships"),
        (F.array(F.lit(ent)) if ent else F.expr("CAST(NULL AS array<string>)")).alias("entity_types"),
        (sel if sel is not None else F.lit(None).cast("string")).alias("selection_status"),
    )
    relation = lambda kind, ids: F.struct(F.lit(kind).alias("type"), ids.alias("ids"))
    named = lambda prefix: F.concat(F.lit(prefix), seq)
    word_ids = F.transform("w", lambda w, i: F.concat(named("w"), F.lit("-"), i.cast("string")))
    fixed = F.array(
        block(0, named("l"), "LINE", F.col("text")),
        block(
            1,
            named("k"),
            "KEY_VALUE_SET",
            rel=F.array(
                relation("CHILD", F.array(named("n"))), relation("VALUE", F.array(F.lit("none"), named("v")))
            ),
            ent="KEY",
        ),
        block(
            2,
            named("v"),
            "KEY_VALUE_SET",
            rel=F.array(relation("CHILD", F.concat(F.array(named("b")), word_ids))),
            ent="VALUE",
        ),
        block(3, named("n"), "WORD", F.col("role")),
        block(
            4,
            named("b"),
            "SELECTION_ELEMENT",
            sel=F.when(F.col("role") == "user", "SELECTED").otherwise("NOT_SELECTED"),
        ),
    )
    words = F.transform(
        "w",
        lambda w, i: block(5, F.concat(named("w"), F.lit("-"), i.cast("string")), "WORD", w),
    )
    return t.select("doc_key", F.explode(F.concat(fixed, words)).alias("b")).select("doc_key", "b.*")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


EVENT_TOOLS = {
    "purchase": "target___create_ticket",
    "click": "target___get_calendar_events",
    "view": "target___send_jabber_message",
    "error": "create_ticket",
    "signup": "target___restart_line",
}


def tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    """A tool call per event: its type names the tool, and dearer events have
    the argument that cheaper ones lack."""
    name = F.lit(None).cast("string")
    for event_type, tool in EVENT_TOOLS.items():
        name = F.when(F.col("event_type") == event_type, F.lit(tool)).otherwise(name)
    day = F.date_format("ts", "yyyy-MM-dd")
    some = F.map_from_arrays(
        F.array(F.lit("category"), F.lit("date"), F.lit("recipient")),
        F.array(F.col("event_type"), day, F.col("user_id").cast("string")),
    )
    more = F.map_from_arrays(
        F.array(F.lit("summary"), F.lit("message")), F.array(F.col("props"), F.col("props"))
    )
    return events(spark, folder).select(
        F.col("event_id").alias("call_id"),
        name.alias("tool_name"),
        F.when(F.col("value") >= 20, F.map_concat(some, more)).otherwise(some).alias("args"),
        F.when(
            F.col("value") >= 50,
            F.map_from_arrays(
                F.array(F.lit("user"), F.lit("day")), F.array(F.col("user_id").cast("string"), day)
            ),
        )
        .otherwise(F.expr("CAST(map() AS map<string,string>)"))
        .alias("details"),
    )


EVENT_MESSAGES = {
    "purchase": "Please open a ticket about my PTO request",
    "click": "What PPE do I need during the shift handoff",
    "view": "How do I enroll in benefits and report a hazard",
    "error": "Which schedule applies",
    "signup": "Who painted the ceiling",
}


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """A message per event: a sentence by its type, then the event's props."""
    text = F.lit(None).cast("string")
    for event_type, sentence in EVENT_MESSAGES.items():
        text = F.when(F.col("event_type") == event_type, F.lit(sentence)).otherwise(text)
    return events(spark, folder).select(
        F.col("event_id").alias("msg_id"), F.concat(text, F.lit(" "), F.col("props")).alias("text")
    )
