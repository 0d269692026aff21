"""Answers from ranked rows, page search, and approximate vector search."""

from __future__ import annotations

import html.entities
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.plan import once
from folioflow.functions.text import ordered_text, strip
from folioflow.operators import search
from folioflow.operators.search import as_matrix, cosine
from folioflow.session import new_run_folder

# How passages and page results are put together.
PASSAGE_BREAK = "\n---\n"
RESULT_BREAK = "\n\n---\n\n"
TOP = 5

# Bands of random hyperplanes, and hyperplanes of a band.
BANDS = 56
BITS = 6


def kept(table: DataFrame, purpose: str) -> DataFrame:
    """The table, written to the shared folder: made once, and of known size."""
    folder = new_run_folder(table.sparkSession, purpose)
    table.write.parquet(folder)
    return table.sparkSession.read.schema(table.schema).parquet(folder)


def render_passages(
    queries: DataFrame, ranked: DataFrame, chunks: DataFrame, not_found: str | None, k: int = TOP
) -> DataFrame:
    """(query_id, answer): passages in rank order, or the not-found sentence.

    ``queries`` has ``id``, ``ranked`` has (query_id, id, rank) and ``chunks``
    (chunk_id, text). Ranked rows are ``k`` for a query, and are written first, so
    that where they are few the chunks meet them without being shuffled.
    """
    found = (
        chunks.select(F.col("chunk_id").alias("id"), "text")
        .join(kept(ranked.select("query_id", "id", "rank"), "ranked"), "id")
        .groupBy("query_id")
        .agg(ordered_text(F.col("rank"), F.col("text"), PASSAGE_BREAK).alias("passages"))
    )
    return (
        queries.select(F.col("id").alias("query_id"))
        .join(found, "query_id", "left")
        .select("query_id", F.coalesce("passages", F.lit(not_found).cast("string")).alias("answer"))
    )


# --- Pages ---------------------------------------------------------------------


def page_title(html: Column) -> Column:
    return _tidy(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def page_text(html: Column) -> Column:
    """Readable text of a page: no script, style, title, comments or tags."""
    bare = F.regexp_replace(
        html,
        r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<title[^>]*>.*?</title>|<!--.*?-->|<[^>]+>",
        " ",
    )
    return _tidy(bare)


ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});"
LAST_CODE, SURROGATES = 0x10FFFF, (0xD800, 0xDFFF)


def decoded(entity: Column) -> Column:
    """What an HTML entity stands for; the entity itself where it is none.

    Decimal, hexadecimal, and those with the names of the standard's own table.
    """
    names = F.create_map(
        *[x for name, code in html.entities.name2codepoint.items() for x in (F.lit(name), F.lit(chr(code)))],
        F.lit("apos"),
        F.lit("'"),
    )
    inner = F.substring(entity, 2, 33)
    body = F.substr(inner, F.lit(1), F.length(inner) - 1)
    hexadecimal = F.when(body.rlike("^#[xX]"), F.substring(body, 3, 6)).when(
        body.startswith("#"), F.hex(F.substring(body, 2, 7).cast("bigint"))
    )

    def character(digits: Column) -> Column:
        code = F.conv(digits, 16, 10).cast("bigint")
        good = (code > 0) & (code <= LAST_CODE) & ~code.between(*SURROGATES)
        return F.when(good, F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32"))

    return F.coalesce(F.when(hexadecimal.isNotNull(), character(hexadecimal)).otherwise(F.try_element_at(names, body)), entity)


def unescaped(text: Column) -> Column:
    """Text with its entities decoded, once each: what comes out is not looked at again."""
    pieces, found = F.split(text, ENTITY), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
    joined = F.zip_with(pieces, found, lambda piece, e: F.concat(piece, F.when(e.isNull(), "").otherwise(decoded(e))))
    return F.when(text.contains("&"), F.array_join(joined, "")).otherwise(text)


def _tidy(text: Column) -> Column:
    return strip(F.regexp_replace(unescaped(text), r"\s+", " "))


def word_set(text: Column) -> Column:
    """Distinct lower-cased words of letters and digits."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.array_distinct(found)


def search_pages(queries: DataFrame, pages: DataFrame, k: int = TOP, snippet_chars: int | None = None) -> DataFrame:
    """(query_id, answer) from (query_id, text) and (page_id, url, html).

    Pages rank by how many of the query's words their title and text hold, ties
    by the lower page id. An answer lists title, text and source per page; the
    text is whole unless ``snippet_chars`` cuts it.
    """
    shown_text = F.col("body") if snippet_chars is None else strip(F.substring("body", 1, snippet_chars))
    read = kept(
        once(
            pages.select("page_id", "url", "html"),
            F.col("html"),
            lambda page: {"title": page_title(page), "body": page_text(page)},
        ).drop("html"),
        "pages",
    )
    asked = queries.select(F.col("query_id").alias("id"), word_set(F.col("text")).alias("terms"))
    held = read.select(
        F.col("page_id").alias("id"), word_set(F.concat_ws(" ", "title", "body")).alias("terms")
    )
    ranked = search.search_terms(asked, held, k)
    block = F.concat(
        F.col("title"),
        F.lit("\n"),
        shown_text,
        F.lit("\nSource: "),
        F.col("url"),
    )
    shown = (
        read.withColumnRenamed("page_id", "id")
        .join(kept(ranked, "ranked"), "id")
        .groupBy("query_id")
        .agg(ordered_text(F.col("rank"), block, RESULT_BREAK).alias("results"))
    )
    nothing = F.concat(F.lit("No web results found for '"), F.col("text"), F.lit("'."))
    return queries.join(shown, "query_id", "left").select(
        "query_id", F.coalesce("results", nothing).alias("answer")
    )


# --- Approximate search ---------------------------------------------------------


def band_keys(vectors: DataFrame, bands: int = BANDS, bits: int = BITS, seed: int = 7) -> DataFrame:
    """Adds ``bands ARRAY<INT>``: signatures of random hyperplanes, per band."""
    schema = vectors.schema
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", bands array<int>"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, powers = None, 1 << np.arange(bits)
        for batch in batches:
            matrix = as_matrix(batch.column("vector"))
            if planes is None:
                planes = np.random.default_rng(seed).standard_normal((matrix.shape[1], bands * bits))
            ups = (matrix @ planes > 0).reshape(len(matrix), bands, bits)
            keys = (ups * powers).sum(axis=2).astype(np.int32)
            listed = pa.array(list(keys), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, listed], names=[*batch.schema.names, "bands"]
            )

    return vectors.mapInArrow(sign, out)


def candidates(queries: DataFrame, vectors: DataFrame, bands: int = BANDS, bits: int = BITS) -> DataFrame:
    """(query_id, id): pairs that share the key of a band, once each.

    An equi-join on (band, key), so a pair that shares none is never formed and
    adaptive execution splits the rows of a popular key.
    """

    def keyed(side: DataFrame, name: str) -> DataFrame:
        signed = band_keys(side.select("id", "vector"), bands, bits)
        return signed.select(F.col("id").alias(name), F.posexplode("bands").alias("band", "key"))

    return keyed(vectors, "id").join(keyed(queries, "query_id"), ["band", "key"]).select("query_id", "id").distinct()


def search_vectors_lsh(
    queries: DataFrame, vectors: DataFrame, k: int = TOP, bands: int = BANDS, bits: int = BITS
) -> DataFrame:
    """(query_id, id, score, rank): approximate top ``k`` of (id, vector) rows.

    Only candidates are scored, by their exact cosine. More bits make fewer
    candidates, more bands find more of the true neighbours; the defaults reach
    a recall of 0.9 where neighbours are far away (a cosine of about 0.4).
    """
    pairs = candidates(queries, vectors, bands, bits)
    scored = (
        pairs.join(vectors.select("id", F.col("vector").alias("_v")), "id")
        .join(queries.select(F.col("id").alias("query_id"), F.col("vector").alias("_q")), "query_id")
        .select("query_id", "id", F.round(cosine(F.col("_q"), F.col("_v")), 6).alias("score"))
    )
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    return scored.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: share of the exact (query_id, id) pairs also found."""
    found = approximate.select("query_id", "id", F.lit(1).alias("hit"))
    return exact.select("query_id", "id").join(found, ["query_id", "id"], "left").agg(
        F.avg(F.coalesce("hit", F.lit(0))).alias("recall"), F.count(F.lit(1)).alias("pairs")
    )
