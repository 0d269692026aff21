"""Queries over files: classification, results, cache, redaction."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow import schemas
from folioflow.catalog import inputs
from folioflow.catalog.registry import query
from folioflow.functions import pii
from folioflow.functions.pii import RedactionSettings, Rule
from folioflow.operators import cache, classify, extract, failures, limits, redact, route
from folioflow.plans import ingest
from folioflow.session import new_run_folder
from folioflow.sources import files as file_source
from folioflow.sources import sinks
from folioflow.streaming import streams

# --- SQL pieces -----------------------------------------------------------------

_SUFFIX_LIST = ", ".join(f"'{s}'" for s in inputs.SUFFIXES)
NAMED = f"""named AS (
  SELECT doc_id, doc_id AS doc_key, text, lang, source,
         'doc_' || doc_id || ([{_SUFFIX_LIST}])[doc_id % {len(inputs.SUFFIXES)} + 1] AS filename
  FROM documents)"""
MODALITY = """CASE WHEN regexp_matches(filename, '\\.(txt|csv|md)$') THEN 'text'
  WHEN regexp_matches(filename, '\\.(png|jpg)$') THEN 'image'
  WHEN regexp_matches(filename, '\\.(pdf|docx)$') THEN 'document'
  WHEN regexp_matches(filename, '\\.(mp3|wav)$') THEN 'audio'
  WHEN filename LIKE '%.mp4' THEN 'video'
  WHEN filename LIKE '%.xlsx' THEN 'spreadsheet' END"""
CLASSIFIED = f"{NAMED}, classified AS (SELECT *, {MODALITY} AS modality FROM named)"


def pattern_of(name: str) -> str:
    return next(r.pattern for r in pii.RULES if r.name == name)


# Queries whose SQL knows no names leave them alone.
RULES_ONLY = RedactionSettings(entities=tuple(e for e in pii.DEFAULT_ENTITIES if e != "PERSON"))
EMAIL, PHONE = pattern_of("email"), pattern_of("phone")
CARD = pii.CARD_PATTERN


def luhn(hit: str) -> str:
    digits = f"regexp_replace({hit}, '[^0-9]', '', 'g')"
    return f"""(list_sum(list_transform(range(1, length({digits}) + 1), lambda i:
      CASE WHEN (length({digits}) - i) % 2 = 1
           THEN CASE WHEN 2 * substr({digits}, i, 1)::INT > 9 THEN 2 * substr({digits}, i, 1)::INT - 9
                     ELSE 2 * substr({digits}, i, 1)::INT END
           ELSE substr({digits}, i, 1)::INT END)) % 10 = 0)"""


def redacted(source: str) -> str:
    """CTE ``redacted``: ``source`` with cards, phones and e-mails replaced."""
    return f"""hits AS (
  SELECT *, list_filter(regexp_extract_all(text, '{CARD}'), lambda h: {luhn('h')}) AS cards,
         list_filter(regexp_extract_all(text, '{CARD}'), lambda h: NOT {luhn('h')}) AS bad_cards
  FROM {source}),
redacted AS (
  SELECT * EXCLUDE (text, cards, bad_cards), text AS raw,
         regexp_replace(regexp_replace(
           list_reduce(cards, lambda t, h: replace(t, h, '[CREDIT_CARD]'), text),
           '{PHONE}', '[PHONE_NUMBER]', 'g'), '{EMAIL}', '[EMAIL_ADDRESS]', 'g') AS text,
         len(regexp_extract_all(text, '{EMAIL}')) AS emails,
         len(regexp_extract_all(text, '{PHONE}')) AS phones,
         len(cards) AS cards, len(bad_cards) AS card_shapes
  FROM hits)"""


def spans_sql(name: str, pattern: str, source: str = "documents", key: str = "doc_id") -> str:
    """CTE ``name``: (doc_key, start, stop, hit, before) of every match."""
    return f"""{name}_parts AS (
  SELECT {key} AS doc_key, text, regexp_extract_all(text, '{pattern}') AS found,
         regexp_split_to_array(text, '{pattern}') AS pieces
  FROM {source} WHERE regexp_matches(text, '{pattern}')),
{name}_steps AS (
  SELECT doc_key, text, unnest(range(1, len(found) + 1)) AS i, unnest(found) AS hit,
         unnest(pieces[1:len(found)]) AS piece FROM {name}_parts),
{name} AS (
  SELECT doc_key, hit, text,
         (sum(length(piece)) OVER w + sum(length(hit)) OVER w - length(hit))::INT AS start,
         (sum(length(piece)) OVER w + sum(length(hit)) OVER w)::INT AS stop
  FROM {name}_steps WINDOW w AS (PARTITION BY doc_key ORDER BY i))"""


# --- Sources --------------------------------------------------------------------


@query(
    "read_files",
    """
SELECT way, 'doc_' || doc_id || '.txt' AS filename, strlen(coalesce(text, '')) AS size, sha256(coalesce(text, '')) AS digest
FROM documents, (VALUES ('batch'), ('stream')) v(way) WHERE coalesce(text, '') <> ''
""",
)
def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as a file of its own, read both ways; the stream runs twice,
    and the second time there is nothing new for it. Spark reads no rows of empty files."""
    uploads = new_run_folder(spark, "uploads")
    named = inputs.documents(spark, folder).select(
        F.concat(F.lit("doc_"), F.col("doc_key").cast("string"), F.lit(".txt")).alias("filename"),
        F.col("text").cast("binary").alias("content"),
    )
    file_source.write_files(named, uploads).write.parquet(new_run_folder(spark, "uploaded"))
    told = [F.col("filename"), F.col("size"), F.sha2("content", 256).alias("digest")]
    arrived, state = new_run_folder(spark, "arrived"), new_run_folder(spark, "state")
    for _ in range(2):
        arriving = file_source.read_files(spark, uploads, stream=True).select(*told)
        streams.run_available(arriving, state, lambda rows, _: rows.write.mode("append").parquet(arrived))
    at_once = file_source.read_files(spark, uploads).select(F.lit("batch").alias("way"), *told)
    return at_once.unionByName(spark.read.parquet(arrived).withColumn("way", F.lit("stream")))


@query(
    "manifest_segments",
    """
WITH lines AS (
  SELECT doc_id, lang, unnest(range(0, len(l))) AS asset_no, unnest(l) AS line
  FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS l FROM documents)),
words AS (
  SELECT doc_id, lang, asset_no, unnest(range(0, len(w))) AS segment_no, unnest(w) AS word
  FROM (SELECT doc_id, lang, asset_no, string_split(line, ' ') AS w FROM lines)),
segments AS (SELECT * FROM words WHERE length(word) > 3)
SELECT doc_id AS job_id, upper(lang) AS semantic_modality, asset_no::INT AS asset_no,
       segment_no::INT AS segment_no, 'out/' || word || '.json' AS result_path, NULL AS reason
FROM segments
UNION ALL
SELECT doc_id, NULL, NULL, NULL, NULL, 'no output segments for this file'
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM segments)
""",
)
def manifest_segments(spark: SparkSession, folder: str) -> DataFrame:
    segments, errors = file_source.manifest_segments(inputs.manifests(spark, folder))
    return segments.unionByName(errors, allowMissingColumns=True)


# --- Classification ---------------------------------------------------------------


@query(
    "classify_files",
    f"""
WITH {CLASSIFIED}
SELECT doc_key, filename, modality,
       CASE WHEN modality IS NULL THEN
         'it isn''t a format I can read (.zip). I can handle images, PDFs, Office documents, '
         || 'spreadsheets, audio, video, and any text or source-code file.' END AS reason
FROM classified
""",
)
def classify_files(spark: SparkSession, folder: str) -> DataFrame:
    named = inputs.files(spark, folder).select("doc_key", "filename")
    classified, rejects = classify.classify_files(named)
    return classified.unionByName(rejects, allowMissingColumns=True)


@query(
    "sniff_text",
    """
SELECT doc_id AS doc_key,
       CASE lang WHEN 'de' THEN false
                 WHEN 'fr' THEN octet_length(encode(text)) >= 8192
                 ELSE true END AS is_text
FROM documents
""",
)
def sniff_text(spark: SparkSession, folder: str) -> DataFrame:
    """French texts get a NUL at their end, German ones a bad first byte, and
    Spanish ones lose their last byte."""
    content, lang = F.col("content"), F.col("lang")
    changed = (
        F.when(lang == "fr", F.concat(content, F.lit(bytearray(b"\x00"))))
        .when(lang == "de", F.concat(F.lit(bytearray(b"\xff")), content))
        .when(lang == "es", F.substr(content, F.lit(1), F.octet_length(content) - 1))
        .otherwise(content)
    )
    files = inputs.files(spark, folder).withColumn("content", changed)
    return classify.sniff_text(files).select("doc_key", "is_text")


@query(
    "decode_plaintext",
    f"""
WITH {CLASSIFIED}
, bytes AS (SELECT *, hex(encode(text)) AS hx, octet_length(encode(text)) AS n FROM classified)
SELECT doc_key, filename, 'plaintext' AS extractor, text || chr(65533) AS text
FROM bytes WHERE modality = 'text' OR (modality IS NULL AND CASE
  -- The bad byte is in the block: without the last four bytes it has to end on a whole character.
  WHEN n < 8192 THEN n <= 3 OR NOT substr(hx, 2 * (n - 3) + 1, 2) BETWEEN '80' AND 'BF'
  ELSE NOT substr(hx, 2 * 8192 + 1, 2) BETWEEN '80' AND 'BF' OR NOT substr(hx, 2 * 8188 + 1, 2) BETWEEN '80' AND 'BF' END)
""",
)
def decode_plaintext(spark: SparkSession, folder: str) -> DataFrame:
    """Every file ends on a byte that cannot be decoded; unlisted names are
    found to be text by their content."""
    files = inputs.files(spark, folder).withColumn(
        "content", F.concat("content", F.lit(bytearray(b"\xff")))
    )
    classified, _ = classify.classify_files(files)
    return classify.decode_plaintext(classified).select("doc_key", "filename", "extractor", "text")


@query(
    "route_extractor",
    f"""
WITH {CLASSIFIED}
SELECT doc_key, false AS forms_mode,
       CASE WHEN modality = 'text' THEN 'plaintext' WHEN modality = 'spreadsheet' THEN 'spreadsheet'
            WHEN filename LIKE '%.pdf' AND lang <> 'en' THEN 'pdf-text'
            WHEN modality = 'image' THEN 'vision' ELSE 'bda' END AS extractor, NULL AS reason
FROM classified WHERE modality IS NOT NULL
UNION ALL
SELECT doc_key, true,
       CASE WHEN modality = 'text' THEN 'plaintext' WHEN modality IN ('image', 'document') THEN 'textract' END,
       CASE WHEN modality NOT IN ('text', 'image', 'document')
            THEN 'form mode only applies to images and PDFs, not ' || modality || ' files.' END
FROM classified WHERE modality IS NOT NULL
""",
)
def route_extractor(spark: SparkSession, folder: str) -> DataFrame:
    classified, _ = classify.classify_files(inputs.files(spark, folder).drop("content"))
    layered = classified.withColumn("has_text_layer", F.col("lang") != "en")
    return (
        classify.route_extractor(layered)
        .withColumn("forms_mode", F.lit(False))
        .unionByName(classify.route_extractor(layered, True).withColumn("forms_mode", F.lit(True)))
        .select("doc_key", "forms_mode", "extractor", "reason")
    )


@query(
    "pdf_text_layer",
    """
WITH pages AS (
  SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)),
           lambda p: trim(p)), lambda p: p <> ''), chr(10) || chr(10)) AS joined
  FROM documents)
SELECT doc_id AS doc_key, CASE WHEN length(joined) >= 32 THEN joined ELSE '' END AS text,
       length(joined) >= 32 AS has_text_layer
FROM pages
""",
)
def pdf_text_layer(spark: SparkSession, folder: str) -> DataFrame:
    return classify.pdf_text_layer(inputs.page_texts(spark, folder))


# --- Results ----------------------------------------------------------------------


@query(
    "flatten_results",
    """
WITH parts AS (
  SELECT doc_id AS doc_key,
    [CASE WHEN lang <> 'en' THEN string_split(text, chr(10))[1] END,
     CASE WHEN lang = 'es' THEN source END, '  ', lang]
    || list_transform(string_split(text, chr(10)),
         lambda l: CASE WHEN length(l) > 80 THEN '## ' || l ELSE l END)
    || [source, ' ' || lang || ' ', 'end'] AS p
  FROM documents)
SELECT doc_key, array_to_string(list_filter(list_transform(p, lambda x: trim(x)),
         lambda x: x IS NOT NULL AND x <> ''), chr(10) || chr(10)) AS text
FROM parts
""",
)
def flatten_results(spark: SparkSession, folder: str) -> DataFrame:
    return extract.flatten_results(inputs.extraction_results(spark, folder))[0]


@query(
    "form_fields",
    """
SELECT conv_id AS doc_key,
  string_agg(text, chr(10) ORDER BY turn) || chr(10) || chr(10) || 'Form fields:' || chr(10)
  || string_agg(role || ' ' || CASE WHEN role = 'user' THEN '[X] ' ELSE '' END
       || array_to_string(regexp_split_to_array(text, '\\s+'), ' '), chr(10) ORDER BY turn) AS text
FROM conversations GROUP BY conv_id
""",
)
def form_fields(spark: SparkSession, folder: str) -> DataFrame:
    return extract.form_fields(inputs.form_blocks(spark, folder))[0]


_ORDER_SHEETS = {"F": "filled", "O": "open", "P": "part filled"}


@query(
    "sheets_to_text",
    """
WITH o AS (
  SELECT o_custkey, o_orderkey, o_orderstatus,
         o_orderkey || ',' || o_totalprice::DECIMAL(18, 2) || ',"' || o_orderpriority || ', ""'
         || o_orderstatus || '""' || '"' AS row,
         CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE 'part filled' END AS name
  FROM orders),
sheets AS (
  SELECT o_custkey, o_orderstatus, '## Sheet: ' || name || chr(10) || chr(10) || 'order,price,note'
         || chr(10) || string_agg(row, chr(10) ORDER BY o_orderkey) AS sheet
  FROM o GROUP BY ALL)
SELECT o_custkey::VARCHAR AS doc_key, string_agg(sheet, chr(10) || chr(10) ORDER BY o_orderstatus) AS text
FROM (SELECT o_custkey, o_orderstatus, sheet FROM sheets) GROUP BY o_custkey
""".replace("GROUP BY ALL", "GROUP BY o_custkey, o_orderstatus, name"),
)
def sheets_to_text(spark: SparkSession, folder: str) -> DataFrame:
    """A workbook per customer, with a sheet per state of their orders."""
    orders = inputs.table(spark, folder, "orders").select(
        "o_custkey",
        "o_orderstatus",
        F.col("o_orderkey").alias("order"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.concat(F.col("o_orderpriority"), F.lit(', "'), F.col("o_orderstatus"), F.lit('"')).alias("note"),
    )
    cells = None
    for number, (status, name) in enumerate(sorted(_ORDER_SHEETS.items())):
        sheet = extract.frame_as_sheet(
            orders.filter(F.col("o_orderstatus") == status), "o_custkey", number, name, "order", ["order", "price", "note"]
        )
        cells = sheet if cells is None else cells.unionByName(sheet)
    return extract.sheets_to_text(cells)


_HELP_CODES = ("ThrottlingException", "NoSuchBucket", "AccessDenied", "OtherError")


@query(
    "failure_report",
    """
WITH f AS (SELECT event_id, props, ['ThrottlingException', 'NoSuchBucket', 'AccessDenied', 'OtherError'][user_id % 4 + 1] AS code
           FROM events WHERE event_type = 'error')
SELECT event_id AS doc_key, 'Handling event ' || event_id || ' failed (' || code || '): '
  || CASE code WHEN 'ThrottlingException' THEN 'AWS is throttling this account; retry in a moment.'
       WHEN 'NoSuchBucket' THEN 'the S3 bucket does not exist. Check DOCS_BUCKET/UPLOAD_BUCKET in .env.'
       WHEN 'AccessDenied' THEN 'the current credentials lack permission for this call.'
       ELSE props END || ' Nothing was lost.' AS report
FROM f
""",
)
def failure_report(spark: SparkSession, folder: str) -> DataFrame:
    code = F.element_at(F.array(*[F.lit(c) for c in _HELP_CODES]), (F.col("user_id") % 4).cast("int") + 1)
    failed = inputs.events(spark, folder).filter(F.col("event_type") == "error").select(
        F.col("event_id").alias("doc_key"),
        F.concat(F.lit("Handling event "), F.col("event_id").cast("string")).alias("doing"),
        code.alias("code"),
        F.col("props").alias("message"),
        F.lit("Nothing was lost.").alias("note"),
    )
    return failures.failure_report(failed).select("doc_key", "report")


# --- Cache --------------------------------------------------------------------------


@query(
    "cache_keys",
    f"""
SELECT doc_id AS doc_key, m AS mode, 'extract-cache/{cache.SCHEMA_TAG}/' || m || '/' || sha256(text) || '.json' AS cache_key
FROM documents, (VALUES ('bda'), ('textract-FORMS'), ('textract-FORMS-TABLES')) v(m)
""",
)
def cache_keys(spark: SparkSession, folder: str) -> DataFrame:
    files = inputs.files(spark, folder)
    keyed = None
    for forms, features in ((False, ("FORMS",)), (True, ("FORMS",)), (True, ("FORMS", "TABLES"))):
        one = cache.cache_keys(files, forms, features).select(
            "doc_key", F.lit(cache.cache_mode(forms, features)).alias("mode"), "cache_key"
        )
        keyed = one if keyed is None else keyed.unionByName(one)
    return keyed


@query(
    "cache_split",
    f"""
WITH {CLASSIFIED}, keyed AS (SELECT *, sha256(text) AS k FROM classified WHERE modality IS NOT NULL),
all_keyed AS (SELECT *, sha256(text) AS k FROM named),
entries AS (
  SELECT k, arg_min(text, a.doc_id) AS stored, arg_min(quality, a.doc_id) AS quality,
         arg_min(toxic, a.doc_id) AS toxic
  FROM all_keyed a JOIN labels l ON a.doc_id = l.doc_id GROUP BY k),
good AS (SELECT * FROM entries WHERE toxic = 0)
SELECT doc_key, filename, modality, 'hit' AS outcome, 'stored: ' || stored AS text,
       CASE WHEN quality = 1 THEN 'vision' ELSE 'cache' END AS extractor
FROM keyed JOIN good USING (k) WHERE modality <> 'text'
UNION ALL
SELECT doc_key, filename, modality, 'miss', NULL, NULL FROM keyed
WHERE modality = 'text' OR k NOT IN (SELECT k FROM good)
""",
)
def cache_split(spark: SparkSession, folder: str) -> DataFrame:
    classified, _ = classify.classify_files(inputs.files(spark, folder).drop("content"))
    text = inputs.documents(spark, folder).select("doc_key", F.col("text").cast("binary").alias("content"))
    # The name columns come from classification, the bytes only feed the key.
    keyed = cache.cache_keys(classified.join(text, "doc_key")).drop("content")
    hits, misses = cache.cache_split(keyed, inputs.cached_entries(spark, folder))
    columns = ["doc_key", "filename", "modality"]
    return hits.select(*columns, F.lit("hit").alias("outcome"), "text", "extractor").unionByName(
        misses.select(
            *columns,
            F.lit("miss").alias("outcome"),
            F.lit(None).cast("string").alias("text"),
            F.lit(None).cast("string").alias("extractor"),
        )
    )


@query(
    "unique_work",
    f"""
WITH {NAMED}
SELECT 'extract-cache/{cache.SCHEMA_TAG}/bda/' || sha256(text) || '.json' AS cache_key,
       min(filename) AS filename, min('uploads/' || filename) AS path, count(*) AS copies
FROM named GROUP BY 1
""",
)
def unique_work(spark: SparkSession, folder: str) -> DataFrame:
    keyed = cache.cache_keys(inputs.files(spark, folder)).drop("content")
    return cache.unique_work(keyed)[0]


@query(
    "fan_back",
    f"""
WITH {NAMED}
SELECT 'uploads/' || filename AS path, filename, length(text) AS n_chars,
       'extract-cache/{cache.SCHEMA_TAG}/bda/' || sha256(text) || '.json' AS cache_key
FROM named
""",
)
def fan_back(spark: SparkSession, folder: str) -> DataFrame:
    """Each distinct text is measured once; every copy gets the number."""
    keyed = cache.cache_keys(inputs.files(spark, folder))
    work, fanout = cache.unique_work(keyed)
    measured = keyed.join(work.select("path"), "path", "left_semi").select(
        "cache_key", F.length(F.col("content").cast("string")).alias("n_chars")
    )
    return cache.fan_back(measured, fanout)


_STORED = """
SELECT 'extract-cache/r1/bda/' || sha256(text) || '.json' AS cache_key, 'r1' AS schema_tag, 'bda' AS mode,
       min(filename) AS filename
FROM named WHERE regexp_matches(text, '\\S') GROUP BY text
"""


@query("cache_store", f"WITH {NAMED}" + _STORED.replace(",\n       min(filename) AS filename", ""))
def cache_store(spark: SparkSession, folder: str) -> DataFrame:
    """Stored twice in a row; the second time adds nothing."""
    done = cache.cache_keys(inputs.files(spark, folder)).select(
        "cache_key",
        F.col("content").cast("string").alias("text"),
        F.lit("document").alias("modality"),
        F.lit("bda").alias("extractor"),
        F.expr("CAST(map() AS map<string,string>)").alias("metadata"),
    )
    path = new_run_folder(spark, "cache")
    sinks.cache_store(done, path)
    return sinks.cache_store(done, path).select("cache_key", "schema_tag", "mode")


@query(
    "publish_documents",
    f"""
WITH {CLASSIFIED}, {redacted('classified')}
SELECT sha256(filename || chr(0) || text) AS doc_key, text, filename AS source_filename,
       modality AS source_modality
FROM redacted WHERE modality IS NOT NULL
""",
)
def publish_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Redacted, staged, checked and published; a second time, which adds nothing."""
    classified, _ = classify.classify_files(inputs.files(spark, folder).drop("content"))
    texts = inputs.documents(spark, folder).select("doc_key", "text")
    redacted_files = redact.redact_text(classified.join(texts, "doc_key"), RULES_ONLY)
    documents = redact.redaction_gate(redacted_files, RULES_ONLY).withColumn("extractor", F.lit("bda"))
    path, check = new_run_folder(spark, "published"), redact.check_staged(RULES_ONLY)
    sinks.publish_documents(documents, path, "first", check)
    sinks.publish_documents(documents, path, "second", check)
    return sinks.read_published(spark, path).select("doc_key", "text", "source_filename", "source_modality")


@query(
    "publish_stream",
    f"""
WITH {CLASSIFIED}, {redacted('classified')}
SELECT sha256(filename || chr(0) || text) AS doc_key, text, filename AS source_filename,
       modality AS source_modality
FROM redacted WHERE modality IS NOT NULL
""",
)
def publish_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same as documents arrive, in three waves; each batch is handed in twice."""
    classified, _ = classify.classify_files(inputs.files(spark, folder).drop("content"))
    texts = inputs.documents(spark, folder).select("doc_key", "text")
    files = classified.join(texts, "doc_key").select("doc_key", "filename", "modality", "text")
    path, state = new_run_folder(spark, "published"), new_run_folder(spark, "state")
    publish = sinks.publish_each(path, "uploads", redact.check_staged(RULES_ONLY))

    def twice(rows: DataFrame, number: int) -> None:
        done = redact.redact_text(rows, RULES_ONLY).withColumn("extractor", F.lit("bda"))
        publish(done, number)
        publish(done, number)

    waves = [files.filter(F.pmod("doc_key", F.lit(3)) == n) for n in range(3)]
    streams.in_waves(waves, lambda arriving: streams.run_available(arriving, state, twice))
    return sinks.read_published(spark, path).select("doc_key", "text", "source_filename", "source_modality")


# --- Redaction ------------------------------------------------------------------------


@query(
    "pii_spans",
    f"""
WITH {spans_sql('email', EMAIL)}, {spans_sql('phone', PHONE)}, {spans_sql('card', CARD)}
SELECT doc_key, 'EMAIL_ADDRESS' AS entity, start, stop, 1.0::DOUBLE AS score FROM email
UNION ALL SELECT doc_key, 'PHONE_NUMBER', start, stop, 0.4 FROM phone
UNION ALL SELECT doc_key, 'CREDIT_CARD', start, stop, 1.0 FROM card WHERE {luhn('hit')}
""",
)
def pii_spans(spark: SparkSession, folder: str) -> DataFrame:
    return redact.pii_spans(inputs.documents(spark, folder))


_CONTEXT = ("the", "que", "die", "los")
_DIGITS = r"\b[0-9]{8,17}\b"
_WEAK = RedactionSettings(
    entities=("US_BANK_NUMBER",),
    threshold=0.0,
    rules=(Rule("digits", "US_BANK_NUMBER", _DIGITS, 0.05),),
)
_NEAR = RedactionSettings(
    entities=("US_BANK_NUMBER",), rules=(Rule("digits", "US_BANK_NUMBER", _DIGITS, 0.05, context=_CONTEXT),)
)


@query(
    "pii_context",
    f"""
WITH {spans_sql('d', _DIGITS)},
near AS (
  SELECT *, regexp_split_to_array(rtrim(substr(text, 1, start)), '\\s+') AS w FROM d),
five AS (SELECT *, lower(array_to_string(w[greatest(len(w) - 4, 1):len(w)], ' ')) AS seen FROM near)
SELECT doc_key, 'US_BANK_NUMBER' AS entity, start, stop, 0.4::DOUBLE AS score
FROM five WHERE regexp_matches(seen, '{"|".join(_CONTEXT)}')
""",
)
def pii_context(spark: SparkSession, folder: str) -> DataFrame:
    """Bare digit runs count only beside a common word of their language."""
    documents = inputs.documents(spark, folder)
    return redact.pii_context(redact.pii_spans(documents, _WEAK), documents, _NEAR)


_DOMAIN = r"[a-z0-9]+\.example\.com"
_OVERLAPPING = RedactionSettings(
    entities=("EMAIL_ADDRESS", "CREDIT_CARD", "US_BANK_NUMBER", "DOMAIN"),
    threshold=0.0,
    rules=tuple(r for r in pii.RULES if r.name in ("email", "card"))
    + (
        Rule("digits", "US_BANK_NUMBER", _DIGITS, 0.05),
        Rule("domain", "DOMAIN", _DOMAIN, 0.5, needs="example"),
    ),
)


@query(
    "pii_resolve",
    f"""
WITH {spans_sql('email', EMAIL)}, {spans_sql('card', CARD)}, {spans_sql('d', _DIGITS)}, {spans_sql('site', _DOMAIN)},
spans AS (
  SELECT doc_key, 'EMAIL_ADDRESS' AS entity, start, stop, 1.0::DOUBLE AS score FROM email
  UNION ALL SELECT doc_key, 'CREDIT_CARD', start, stop, 1.0 FROM card WHERE {luhn('hit')}
  UNION ALL SELECT doc_key, 'US_BANK_NUMBER', start, stop, 0.05 FROM d
  UNION ALL SELECT doc_key, 'DOMAIN', start, stop, 0.5 FROM site)
SELECT * FROM spans s WHERE NOT EXISTS (
  SELECT 1 FROM spans b WHERE b.doc_key = s.doc_key AND b.start < s.stop AND s.start < b.stop
    AND (-b.score, b.start - b.stop, b.start, b.entity) < (-s.score, s.start - s.stop, s.start, s.entity))
""",
)
def pii_resolve(spark: SparkSession, folder: str) -> DataFrame:
    return redact.pii_resolve(redact.pii_spans(inputs.documents(spark, folder), _OVERLAPPING))


@query(
    "redact_text",
    f"""
WITH {redacted('documents')}
SELECT doc_id AS doc_key, text, emails, phones, cards, card_shapes, 'rules' AS engine FROM redacted
""",
)
def redact_text(spark: SparkSession, folder: str) -> DataFrame:
    counts = lambda entity: F.coalesce(F.try_element_at("entity_counts", F.lit(entity)), F.lit(0))
    return redact.redact_text(inputs.documents(spark, folder)).select(
        "doc_key",
        "text",
        counts("EMAIL_ADDRESS").alias("emails"),
        counts("PHONE_NUMBER").alias("phones"),
        counts("CREDIT_CARD").alias("cards"),
        "card_shapes",
        "engine",
    )


_NAME_TOKEN = r"[\p{L}][\p{L}''’-]*"


@query(
    "redact_person_names",
    f"""
WITH names AS (
  SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[\\p{{L}}]{{9,}}'))) AS name FROM benchmark),
{spans_sql('t', _NAME_TOKEN)}
SELECT doc_key, 'PERSON' AS entity, start, stop, 0.85::DOUBLE AS score
FROM t WHERE lower(hit) IN (SELECT name FROM names)
""",
)
def redact_person_names(spark: SparkSession, folder: str) -> DataFrame:
    """Long words of the benchmark texts stand in for a list of names."""
    names = inputs.questions(spark, folder).select(
        F.explode(F.regexp_extract_all("text", F.lit(r"[\p{L}]{9,}"), F.lit(0))).alias("name")
    )
    return redact.redact_person_names(inputs.documents(spark, folder), names)


_TWO_CAPITALS = r"\b[A-Z][a-z]+ [A-Z][a-z]+\b"


def _capitals():
    """A finder: two words with capitals side by side."""
    pattern = re.compile(_TWO_CAPITALS, re.ASCII)
    return lambda texts: [[(*m.span(), 0.6) for m in pattern.finditer(t)] for t in texts]


@query(
    "found_person_names",
    f"""
WITH {spans_sql('t', _TWO_CAPITALS)}
SELECT doc_key, 'PERSON' AS entity, start, stop, 0.6::DOUBLE AS score FROM t
""",
)
def found_person_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names by a finder of the caller's, over all documents."""
    return redact.redact_person_names(inputs.documents(spark, folder), finder=_capitals)


@query(
    "redaction_audit",
    f"""
WITH {CLASSIFIED}, {redacted('classified')},
counted AS (
  SELECT lang, coalesce(modality, 'none') AS extractor, unnest(['EMAIL_ADDRESS', 'PHONE_NUMBER', 'CREDIT_CARD', 'CARD_SHAPE_ONLY']) AS entity,
         unnest([emails, phones, cards, card_shapes]) AS n FROM redacted)
SELECT entity, extractor, lang, sum(n)::BIGINT AS hits, count(*) AS documents
FROM counted WHERE n > 0 GROUP BY ROLLUP (entity, extractor, lang)
""",
)
def redaction_audit(spark: SparkSession, folder: str) -> DataFrame:
    named = inputs.documents(spark, folder).withColumn(
        "extractor",
        F.coalesce(classify.modality_by_name(inputs.filename(F.col("doc_key"))), F.lit("none")),
    )
    return redact.redaction_audit(redact.redact_text(named))


@query(
    "redaction_gate",
    f"""
WITH {redacted('documents')}
SELECT doc_id AS doc_key, text FROM redacted
""",
)
def redaction_gate(spark: SparkSession, folder: str) -> DataFrame:
    done = redact.redact_text(inputs.documents(spark, folder), RULES_ONLY)
    return redact.redaction_gate(done, RULES_ONLY).select("doc_key", "text")


# --- The whole upload --------------------------------------------------------------------


_UPLOADED = f"""
WITH {CLASSIFIED}, kinds AS (SELECT * EXCLUDE (modality), coalesce(modality, 'text') AS modality FROM classified),
{redacted('kinds')},
names AS (SELECT list(DISTINCT lower(w)) AS l FROM (SELECT unnest(regexp_extract_all(text, '[\\p{{L}}]{{9,}}')) AS w FROM benchmark)),
cut AS (
  SELECT *, regexp_extract_all(text, '{_NAME_TOKEN}') AS found, regexp_split_to_array(text, '{_NAME_TOKEN}') AS pieces FROM redacted),
told AS (
  SELECT doc_id, filename, modality, raw, min(doc_id) OVER (PARTITION BY raw) AS first,
    array_to_string(list_transform(list_zip(pieces, found), lambda z:
      z[1] || CASE WHEN z[2] IS NULL THEN '' WHEN list_contains(l, lower(z[2])) THEN '[PERSON]' ELSE z[2] END), '') AS text
  FROM cut, names),
read AS (SELECT * FROM told WHERE modality = 'text' OR first % 13 <> 0)
SELECT DISTINCT sha256(filename || chr(0) || text) AS doc_key, text, filename AS source_filename, modality AS source_modality,
  CASE modality WHEN 'text' THEN 'plaintext' WHEN 'spreadsheet' THEN 'spreadsheet' WHEN 'image' THEN 'vision' ELSE 'bda' END AS extractor,
  0 AS extracted_again, (SELECT count(*) FROM told) - (SELECT count(*) FROM read) AS files_without_result
FROM read WHERE regexp_matches(text, '\\S')
"""


@query("ingest_job", _UPLOADED)
def ingest_job(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as uploads, twice: the second run extracts nothing and publishes
    nothing. Some keys have no extraction result; their files are told of."""
    files = inputs.files(spark, folder).drop("lang")
    keyed = cache.cache_keys(files.select("doc_key", "content"))
    made = keyed.groupBy("cache_key").agg(F.min("doc_key").alias("first"), F.min(F.col("content").cast("string")).alias("text"))
    extracted = made.filter(F.col("first") % 13 != 0).select("cache_key", "text")
    names = inputs.questions(spark, folder).select(
        F.explode(F.regexp_extract_all("text", F.lit(r"[\p{L}]{9,}"), F.lit(0))).alias("name")
    )
    stored, published = new_run_folder(spark, "cache"), new_run_folder(spark, "published")
    told, again = [], 0
    for batch in ("first", "second"):
        run = ingest.ingest_files(files.drop("doc_key"), extracted, sinks.read_or_empty(spark, stored, schemas.CACHE), names=names)
        again = run.extracted.count()
        told.append(ingest.store(run, stored, published, batch).filter(F.col("reason").endswith(ingest.NO_RESULT)).count())
    return sinks.read_published(spark, published).select(
        "doc_key", "text", "source_filename", "source_modality", "extractor",
        F.lit(again).alias("extracted_again"), F.lit(told[0]).alias("files_without_result"),
    )


# --- Summaries and costs ----------------------------------------------------------------


_EXTRACTOR_SQL = """CASE WHEN modality = 'text' THEN 'plaintext' WHEN modality = 'spreadsheet' THEN 'spreadsheet'
  WHEN modality = 'image' THEN 'vision' ELSE 'bda' END"""


def _extracted(spark: SparkSession, folder: str) -> DataFrame:
    classified, _ = classify.classify_files(
        inputs.documents(spark, folder).withColumn("filename", inputs.filename(F.col("doc_key")))
    )
    return classify.route_extractor(classified).drop("reason")


@query(
    "document_summary",
    f"""
WITH {CLASSIFIED},
e AS (SELECT *, {_EXTRACTOR_SQL} AS extractor,
        len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS n FROM classified
      WHERE modality IS NOT NULL),
labelled AS (
  SELECT *, CASE WHEN lang = 'es' THEN 'from cache' ELSE CASE extractor WHEN 'plaintext' THEN 'read directly'
         WHEN 'spreadsheet' THEN 'parsed locally' WHEN 'vision' THEN 'read as an image'
         ELSE 'read with Bedrock Data Automation' END END AS source_label FROM e)
SELECT doc_key, n AS n_words, substr(text, 1, 3000) AS preview, source_label,
       format('{{:,}}', n) || ' words · ' || source_label AS caption
FROM labelled
""",
)
def document_summary(spark: SparkSession, folder: str) -> DataFrame:
    documents = _extracted(spark, folder).withColumn("from_cache", F.col("lang") == "es")
    return route.document_summary(documents).select(
        "doc_key", "n_words", "preview", "source_label", "caption"
    )


@query(
    "extraction_cost",
    f"""
WITH {CLASSIFIED},
e AS (SELECT *, {_EXTRACTOR_SQL} AS extractor, length(text) - length(replace(text, chr(10), '')) + 1 AS units
      FROM classified WHERE modality IS NOT NULL),
priced AS (SELECT *, units * CASE WHEN lang = 'es' THEN 0 WHEN extractor = 'vision' THEN 0.001
      WHEN extractor = 'bda' AND modality = 'document' THEN 0.01 WHEN extractor = 'bda' AND modality = 'audio' THEN 0.006
      WHEN extractor = 'bda' AND modality = 'video' THEN 0.05 ELSE 0 END::DOUBLE AS cost FROM e)
SELECT extractor, modality, count(*) AS documents, sum(units)::BIGINT AS units, round(sum(cost), 4) AS cost
FROM priced GROUP BY ROLLUP (extractor, modality)
""",
)
def extraction_cost(spark: SparkSession, folder: str) -> DataFrame:
    """Each line of a document counts as a page, an image or a minute."""
    documents = _extracted(spark, folder).select(
        "extractor",
        "modality",
        F.size(F.split("text", "\n")).alias("units"),
        (F.col("lang") == "es").alias("from_cache"),
    )
    return limits.extraction_cost(documents).withColumn("cost", F.round("cost", 4))
