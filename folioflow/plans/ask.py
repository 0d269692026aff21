"""A table of questions, from small talk to answers out of the corpus."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.operators import chunks, passages, redact, route, screen, search


def corpus_chunks(documents: DataFrame) -> DataFrame:
    """Redacted documents of (doc_key, text, ...) in chunks; row by row."""
    return chunks.chunk_fixed(redact.redact_text(documents))


def answer_from_corpus(
    questions: DataFrame, corpus: DataFrame, not_found: str | None, k: int = passages.TOP
) -> DataFrame:
    """(query_id, answer) for (id, text) questions over a chunk table."""
    asked = chunks.hash_vectors(questions, "id")
    ranked = search.search_hashed(asked, chunks.hash_vectors(corpus, "chunk_id"), k)
    return passages.render_passages(asked, ranked, corpus, not_found, k)


@dataclass
class Answered:
    greetings: DataFrame
    refused: DataFrame
    routed: DataFrame
    answers: DataFrame


def ask(messages: DataFrame, corpus: DataFrame, pages: DataFrame) -> Answered:
    """Messages (msg_id, text): greet, refuse, route, retrieve, screen.

    The cheap splits come first, so retrieval only sees what they leave. One
    message may have several routes and so several answers; the corpus is
    searched once for all of them.
    """
    greetings, rest = route.split_greetings(messages)
    screened = screen.screen_input(rest)
    routed = route.route_requests(screened.filter(~F.col("blocked")).drop("blocked", "categories"))
    internal = routed.filter(F.col("route") != "web")
    asked = internal.select(F.col("msg_id").alias("id"), "text").dropDuplicates(["id"])
    found = answer_from_corpus(asked, corpus, None)
    sentence = F.lit(None).cast("string")
    for area, text in route.NOT_FOUND.items():
        sentence = F.when(F.col("route") == area, F.lit(text)).otherwise(sentence)
    from_corpus = internal.select(F.col("msg_id").alias("query_id"), "route").join(found, "query_id").select(
        "query_id", "route", F.coalesce("answer", sentence).alias("answer")
    )
    web = routed.filter(F.col("route") == "web").select(F.col("msg_id").alias("query_id"), "text")
    from_web = passages.search_pages(web, pages).select("query_id", F.lit("web").alias("route"), "answer")
    answers = screen.screen_output(
        from_corpus.unionByName(from_web).select(
            F.col("query_id").alias("msg_id"), "route", F.col("answer").alias("text")
        )
    )
    return Answered(greetings, screened.filter("blocked"), routed, answers)
