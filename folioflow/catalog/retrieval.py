"""Queries over chunks, vectors and pages."""

from __future__ import annotations

import html.entities

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.catalog import inputs
from folioflow.catalog.files import redacted
from folioflow.catalog.registry import query
from folioflow.operators import chunks, passages, search
from folioflow.plans.ask import corpus_chunks
from folioflow.session import new_run_folder
from folioflow.streaming import streams

NOT_FOUND = "No matching documents found."


def chunked(source: str, key: str = "doc_id") -> str:
    """CTE ``chunks``: 60 words each, 12 shared with the next."""
    return f"""worded AS (
  SELECT {key} AS k, list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '') AS w FROM {source}),
numbered AS (
  SELECT k, w, unnest(range(0, greatest(ceil((len(w) - 12) / 48.0)::INT, 1))) AS n FROM worded WHERE len(w) > 0),
chunks AS (
  SELECT k || ':' || n AS chunk_id, k AS doc_key, n::INT AS chunk_no,
         array_to_string(w[n * 48 + 1 : n * 48 + 60], ' ') AS text FROM numbered)"""


def hashed(name: str, source: str, key: str) -> str:
    """CTE ``name``: (id, bucket, tf, norm2)."""
    return f"""{name}_terms AS (
  SELECT {key} AS id, unnest(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: w <> '')) AS word FROM {source}),
{name}_tf AS (
  SELECT id, (('0x' || substr(md5(word), 1, 8))::BIGINT % 1024)::INT AS bucket, count(*)::INT AS tf
  FROM {name}_terms GROUP BY 1, 2),
{name} AS (SELECT *, sum(tf * tf) OVER (PARTITION BY id)::BIGINT AS norm2 FROM {name}_tf)"""


RANKED = f"""{redacted('documents')}, {chunked('redacted')},
{hashed('c', 'chunks', 'chunk_id')}, {hashed('q', 'benchmark', 'item_id')},
dots AS (
  SELECT q.id AS query_id, c.id AS id, sum(q.tf * c.tf) / sqrt((any_value(q.norm2) * any_value(c.norm2))::DOUBLE) AS score
  FROM q JOIN c USING (bucket) GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM dots QUALIFY rank <= 5)"""


@query("chunk_fixed", f"WITH {chunked('documents')} SELECT * FROM chunks")
def chunk_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.chunk_fixed(inputs.documents(spark, folder)).drop("lang")


@query(
    "embed_chunks",
    f"""WITH {chunked('documents')}, {hashed('c', 'chunks', 'chunk_id')}
SELECT id AS chunk_id, bucket, tf, round(tf / sqrt(norm2::DOUBLE), 6) AS weight FROM c""",
)
def embed_chunks(spark: SparkSession, folder: str) -> DataFrame:
    vectors = chunks.embed_chunks(chunks.chunk_fixed(inputs.documents(spark, folder)))
    return vectors.withColumn("weight", F.round("weight", 6))


@query(
    "search_hashed",
    f"WITH {RANKED} SELECT query_id, id, rank::INT AS rank, round(score, 6) AS score FROM ranked",
)
def search_hashed(spark: SparkSession, folder: str) -> DataFrame:
    corpus = corpus_chunks(inputs.documents(spark, folder))
    ranked = search.search_hashed(
        chunks.hash_vectors(inputs.questions(spark, folder), "id"), chunks.hash_vectors(corpus, "chunk_id")
    )
    return ranked.withColumn("score", F.round("score", 6))


@query(
    "render_passages",
    f"""WITH {RANKED}, found AS (
  SELECT query_id, string_agg(text, chr(10) || '---' || chr(10) ORDER BY rank) AS answer
  FROM ranked JOIN chunks ON id = chunk_id GROUP BY query_id)
SELECT item_id AS query_id, coalesce(answer, '{NOT_FOUND}') AS answer
FROM benchmark LEFT JOIN found ON item_id = query_id""",
)
def render_passages(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship: redact, chunk, hash, rank, and put the passages together."""
    corpus = passages.kept(corpus_chunks(inputs.documents(spark, folder)).select("chunk_id", "text"), "corpus")
    asked = chunks.hash_vectors(inputs.questions(spark, folder), "id")
    ranked = search.search_hashed(asked, chunks.hash_vectors(corpus, "chunk_id"))
    return passages.render_passages(asked, ranked, corpus, NOT_FOUND)


def _centres(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Queries are the mean vector of every label; the corpus is all vectors."""
    vectors = inputs.table(spark, folder, "embeddings")
    means = (
        vectors.select("label", F.posexplode("embedding").alias("at", "v"))
        .groupBy("label", "at")
        .agg(F.avg(F.col("v").cast("double")).alias("v"))
        .groupBy("label")
        .agg(F.sort_array(F.collect_list(F.struct("at", "v"))).alias("m"))
    )
    return (
        means.select(F.col("label").alias("id"), F.transform("m", lambda x: x["v"]).alias("vector")),
        vectors.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector")),
    )


@query(
    "search_vectors",
    """
WITH parts AS (SELECT label, unnest(range(1, 65)) AS place, unnest(embedding)::DOUBLE AS v FROM embeddings),
means AS (SELECT label, place, avg(v) AS v FROM parts GROUP BY 1, 2),
centres AS (SELECT label, list(v ORDER BY place) AS c FROM means GROUP BY label),
scored AS (SELECT centres.label AS query_id, vec_id AS id, round(list_cosine_similarity(c, embedding::DOUBLE[]), 6) AS score
           FROM centres, embeddings)
SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id))::INT AS rank FROM scored QUALIFY rank <= 5
""",
)
def search_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return search.search_vectors(*_centres(spark, folder))


@query("search_vectors_lsh")
def search_vectors_lsh(spark: SparkSession, folder: str) -> DataFrame:
    return passages.search_vectors_lsh(*_centres(spark, folder))


@query(
    "lsh_recall",
    "SELECT true AS finds_nine_tenths, true AS scores_under_half, count(*) AS queries FROM embeddings WHERE vec_id % 50 = 0",
)
def lsh_recall(spark: SparkSession, folder: str) -> DataFrame:
    """Recall at 5, and the share of pairs that are scored, where rows have neighbours:
    each queried vector has six near copies among all vectors."""
    vectors = inputs.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    asked = vectors.filter(F.col("id") % 50 == 0)
    moved = F.transform("vector", lambda v, i: v * (1 + ((i * 7 + F.col("copy") * 3 + F.col("id")) % 5 - 2) * 0.05))
    copies = asked.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(6)))).select(
        (-1 - F.col("id") * 10 - F.col("copy")).alias("id"), moved.alias("vector")
    )
    rows = passages.kept(vectors.unionByName(copies), "rows")
    near = passages.search_vectors_lsh(asked, rows, bands=24, bits=12)
    found = passages.recall(near, search.search_vectors(asked, rows))
    scored = passages.candidates(asked, rows, 24, 12).agg(F.count(F.lit(1)).alias("pairs"))
    every = asked.agg(F.count(F.lit(1)).alias("queries")).join(rows.agg(F.count(F.lit(1)).alias("rows")))
    return found.select("recall").join(scored).join(every).select(
        (F.col("recall") >= 0.9).alias("finds_nine_tenths"),
        (2 * F.col("pairs") < F.col("queries") * F.col("rows")).alias("scores_under_half"),
        "queries",
    )


_NAMED = ", ".join(
    f"{{'n': '{n}', 'c': chr({c})}}" for n, c in [*html.entities.name2codepoint.items(), ("apos", 39)]
)


def _entity_sql(entity: str) -> str:
    code = f"""(CASE WHEN regexp_matches({entity}, '^&#[xX]') THEN ('0x' || regexp_extract({entity}, '[xX]([0-9a-fA-F]+)', 1))::BIGINT
      ELSE regexp_extract({entity}, '#([0-9]+)', 1)::BIGINT END)"""
    return f"""CASE WHEN {entity} LIKE '&#%' THEN
      CASE WHEN {code} BETWEEN 1 AND 1114111 AND NOT {code} BETWEEN 55296 AND 57343 THEN chr({code}::INT) ELSE {entity} END
      ELSE coalesce((SELECT any_value(c) FROM named WHERE n = regexp_extract({entity}, '^&(.*);$', 1)), {entity}) END"""


def _tidy_sql(text: str) -> str:
    """Entities are told apart once in a table of their own, then put between the pieces."""
    pieces = f"regexp_split_to_array({text}, '{passages.ENTITY}')"
    found = f"regexp_extract_all({text}, '{passages.ENTITY}')"
    text = f"""array_to_string(list_transform(list_zip({pieces}, {found}), lambda z: z[1] || CASE WHEN z[2] IS NULL THEN '' ELSE known[z[2]] END), '')"""
    white = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
    return rf"regexp_replace(regexp_replace({text}, '[ \t-\r]+', ' ', 'g'), '\A[{white}]+|[{white}]+\z', '', 'g')"


_BARE_SQL = (
    r"regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<title[^>]*>.*?</title>"
    r"|<!--.*?-->|<[^>]+>', ' ', 'g')"
)
_WORDS_SQL = r"list_distinct(regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+'))"


@query(
    "search_pages",
    rf"""
WITH named AS (SELECT unnest([{_NAMED}], recursive := true)),
met AS (SELECT DISTINCT unnest(regexp_extract_all(html, '{passages.ENTITY}')) AS e FROM pages),
table_of AS (SELECT coalesce(map_from_entries(list((e, {_entity_sql("e")}))), MAP {{}}) AS known FROM met),
page AS (
  SELECT page_id, url, {_tidy_sql("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title, {_tidy_sql(_BARE_SQL)} AS body
  FROM pages, table_of),
held AS (SELECT page_id, unnest({_WORDS_SQL.format("concat_ws(' ', title, body)")}) AS word FROM page),
asked AS (SELECT item_id, unnest({_WORDS_SQL.format("text")}) AS word FROM benchmark),
counted AS (SELECT item_id, page_id, count(*) AS n FROM asked JOIN held USING (word) GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY n DESC, page_id) AS rank FROM counted QUALIFY rank <= 5),
found AS (
  SELECT item_id, string_agg(title || chr(10) || body || chr(10) || 'Source: ' || url, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS results
  FROM ranked JOIN page USING (page_id) GROUP BY item_id)
SELECT item_id AS query_id, coalesce(results, 'No web results found for ' || chr(39) || text || chr(39) || '.') AS answer
FROM benchmark LEFT JOIN found USING (item_id)
""",
)
def search_pages(spark: SparkSession, folder: str) -> DataFrame:
    asked = inputs.questions(spark, folder).withColumnRenamed("id", "query_id")
    return passages.search_pages(asked, inputs.table(spark, folder, "pages"))


_CHANGED = """changed AS (
  SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN text || ' and more' ELSE text END AS text FROM documents WHERE doc_id % 11 <> 0)"""
_INDEXED = f"WITH {_CHANGED}, {chunked('changed')} SELECT chunk_id, doc_key::VARCHAR AS doc_key, chunk_no, text FROM chunks"


def _versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The documents, and what becomes of them: a seventh changes, an eleventh goes."""
    first = inputs.documents(spark, folder).select("doc_key", "text")
    key, text = F.col("doc_key"), F.col("text")
    later = F.when(key % 11 == 0, F.lit(None)).when(key % 7 == 0, F.concat(text, F.lit(" and more"))).otherwise(text)
    return first, first.withColumn("text", later)


@query("index_incremental", _INDEXED)
def index_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Indexed, then changed, then the same again, which adds nothing."""
    first, second = _versions(spark, folder)
    path = new_run_folder(spark, "index")
    for number, documents in enumerate((first, second, second)):
        streams.index_batch(documents, path, f"run-{number}")
    return streams.read_index(spark, path)


@query("index_stream", _INDEXED)
def index_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same as the documents arrive."""
    path, state = new_run_folder(spark, "index"), new_run_folder(spark, "state")
    streams.in_waves(list(_versions(spark, folder)), lambda arriving: streams.index_stream(arriving, path, state))
    return streams.read_index(spark, path)
