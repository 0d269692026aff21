"""Removing personal data from document text.

All of it is row-local: spans, overlap resolution and replacement are array
expressions over the row's own text, so a document table is redacted in the
stage that reads it. Names are found there too, by an automaton over the tokens of
the listed names or by a finder of the caller's; only hits leave the stage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
import pyarrow.dataset
import pyarrow.fs
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from folioflow.functions import pii
from folioflow.functions.pii import RedactionSettings
from folioflow.functions.plan import once
from folioflow.functions.text import is_blank
from folioflow.session import new_run_folder

DEFAULT = RedactionSettings()
NAME_SCORE = 0.85
#: Names of one automaton; a longer list is cut by the first token of its names, and
#: the texts are read once for each part.
NAMES_AT_ONCE = 200_000
TOKEN = regex.compile(r"\p{L}[\p{L}'’-]*")
BLANKS = regex.compile(r"[\s\p{Z}]+")

#: What a finder is: made once per task, it takes texts and gives (start, stop, score) of each.
Finder = Callable[[list[str]], list[list[tuple[int, int, float]]]]


class RedactionUnavailable(RuntimeError):
    """Redaction is on but its rules or names cannot be loaded."""


def pii_spans(documents: DataFrame, settings: RedactionSettings = DEFAULT) -> DataFrame:
    """(doc_key, entity, start, stop, score), one row per hit.

    Context words are taken into account; hits under the threshold are left
    out. Offsets count characters from 0 and ``stop`` is exclusive.
    """
    # explode_outer, then a filter: for a plain explode the optimizer adds a
    # filter on the array below it, which would find all spans twice.
    return (
        documents.select("doc_key", pii.text_spans(F.col("text"), settings).alias("spans"))
        .select("doc_key", F.explode_outer("spans").alias("s"))
        .filter(F.col("s").isNotNull())
        .select("doc_key", "s.entity", "s.start", "s.stop", "s.score")
    )


def pii_context(spans: DataFrame, documents: DataFrame, settings: RedactionSettings = DEFAULT) -> DataFrame:
    """Lift low-score spans that follow one of their entity's context words.

    For spans from elsewhere (a model, a stored run without context). Spans
    meet their document by an equi-join; the text window is cut per span.
    """
    words: dict[str, set[str]] = {}
    for rule in settings.rules:
        words.setdefault(rule.entity, set()).update(rule.context)
    near = F.col("near")
    lifted = F.lit(False)
    for entity, context in sorted(words.items()):
        seen = F.lit(False)
        for word in sorted(context):
            seen = seen | near.contains(word)
        if context:
            lifted = lifted | ((F.col("entity") == entity) & seen)
    return (
        spans.join(documents.select("doc_key", "text"), "doc_key")
        .withColumn("near", pii.words_before(F.col("text"), F.col("start")))
        .withColumn(
            "score",
            F.when(
                (F.col("score") < settings.threshold) & lifted,
                F.least(F.lit(1.0), F.round(F.col("score") + pii.CONTEXT_BOOST, 6)),
            ).otherwise(F.col("score")),
        )
        .filter(F.col("score") >= settings.threshold)
        .select("doc_key", "entity", "start", "stop", "score")
    )


def pii_resolve(spans: DataFrame) -> DataFrame:
    """Non-overlapping spans per document: score, then length, then leftmost.

    A group is the hits of one document, so it is bounded by that document.
    """
    gathered = spans.groupBy("doc_key").agg(
        F.collect_list(F.struct("entity", "start", "stop", "score")).alias("spans")
    )
    return gathered.select(
        "doc_key", F.explode_outer(pii.resolve_spans(F.col("spans"))).alias("s")
    ).select("doc_key", "s.entity", "s.start", "s.stop", "s.score")


def redact_text(
    documents: DataFrame,
    settings: RedactionSettings = DEFAULT,
    extra_spans: DataFrame | None = None,
    names: DataFrame | None = None,
    finder: Callable[[], Finder] | None = None,
) -> DataFrame:
    """Documents with ``text`` redacted, plus ``entity_counts``, ``card_shapes``
    (card-shaped numbers with a wrong check digit, which stay) and ``engine``.

    Blank text is returned as it is. Counts are over hits before overlaps are
    resolved. Names of a list or a finder are found in the row, so without
    ``extra_spans``, which are joined by document key, there is no shuffle.
    """
    no_counts = F.expr("CAST(map() AS map<string,int>)")
    if not settings.enabled:
        return documents.withColumns(
            {"entity_counts": no_counts, "card_shapes": F.lit(0), "engine": F.lit("disabled")}
        )
    base = documents.drop("entity_counts", "card_shapes", "engine")
    text = F.col("text")
    found = F.when(is_blank(text), F.expr(pii.EMPTY_SPANS)).otherwise(pii.text_spans(text, settings))
    if "PERSON" in settings.entities and (names is not None or finder is not None):
        base = with_names(base, names, finder)
        found = F.concat(found, F.filter("_names", lambda s: s["score"] >= settings.threshold))
    if extra_spans is not None:
        extra = (
            extra_spans.filter(F.col("entity").isin(*settings.entities))
            .filter(F.col("score") >= settings.threshold)
            .groupBy("doc_key")
            .agg(
                F.collect_list(F.struct("entity", "start", "stop", "score"))
                .cast(pii.SPAN_TYPE)
                .alias("_extra")
            )
        )
        base = base.join(extra, "doc_key", "left")
        found = F.concat(found, F.coalesce("_extra", F.expr(pii.EMPTY_SPANS)))

    def results(spans):
        hit = F.size(spans) > 0
        return {
            "text": F.when(hit, pii.replace_spans(text, pii.resolve_spans(spans))).otherwise(text),
            "entity_counts": F.when(hit, pii.count_entities(spans)).otherwise(no_counts),
            "card_shapes": pii.card_shapes_only(text),
        }

    return once(base, found, results).drop("_extra", "_names").withColumn("engine", F.lit("rules"))


class NameAutomaton:
    """Finds listed names in texts, in one walk over a text's tokens.

    A name is the row of its tokens and of what stands between them, in lower case
    and with any white space as one blank. What stands around it is not compared.
    """

    def __init__(self, names: list[str | None]) -> None:
        self.codes: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for name in names:
            parts = [self.codes.setdefault(p, len(self.codes) + 1) for p, _, _ in self.parts(name or "")]
            if parts:
                self.automaton.add_word(tuple(parts), len(parts))
        self.empty = not self.codes
        if not self.empty:
            self.automaton.make_automaton()

    @staticmethod
    def parts(text: str) -> list[tuple[str, int, int]]:
        """(part, start, stop): tokens, and between them what is there, marked as such."""
        out: list[tuple[str, int, int]] = []
        for token in TOKEN.finditer(text):
            if out:
                out.append(("\0" + BLANKS.sub(" ", text[out[-1][2] : token.start()]).lower(), 0, 0))
            out.append((token[0].lower(), *token.span()))
        return out

    def __call__(self, text: str) -> list[tuple[int, int]]:
        if self.empty:
            return []
        parts = self.parts(text)
        row = tuple(self.codes.get(p, 0) for p, _, _ in parts)
        return [(parts[end - length + 1][1], parts[end][2]) for end, length in self.automaton.iter(row)] if row else []


def name_parts(names: DataFrame) -> tuple[str, int]:
    """The list in a folder, in so many parts by first token.

    Tasks read it there: it never passes through the driver.
    """
    spark = names.sparkSession
    folder = new_run_folder(spark, "names")
    first = F.regexp_extract(F.lower("name"), r"\p{L}[\p{L}'’-]*", 0)
    wanted = names.select("name", first.alias("_first")).filter(F.col("_first") != "").distinct()
    wanted.write.parquet(f"{folder}/all")
    wanted = spark.read.schema("name STRING, _first STRING").parquet(f"{folder}/all")
    count = max(1, -(-wanted.count() // NAMES_AT_ONCE))
    part = F.pmod(F.xxhash64("_first"), F.lit(count)).cast("int")
    wanted.select("name", part.alias("part")).repartition("part").write.partitionBy("part").parquet(f"{folder}/parts")
    return f"{folder}/parts", count


def with_listed(documents: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """Adds ``column``: the spans of all listed names in ``text``, also of those within others."""
    folder, count = name_parts(names)
    text = documents.columns.index("text")
    out = StructType([*documents.schema.fields, StructField(column, StructType.fromDDL(f"s {pii.SPAN_TYPE}")["s"].dataType)])
    kind = to_arrow_type(out[column].dataType)

    def search(number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            files, root = pyarrow.fs.FileSystem.from_uri(f"{folder}/part={number}")
            there = files.get_file_info(root).type != pyarrow.fs.FileType.NotFound
            listed = pyarrow.dataset.dataset(root, filesystem=files).to_table(columns=["name"]) if there else None
            find = NameAutomaton(listed.column("name").to_pylist() if listed else [])
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    before = part.column(part.num_columns - 1).to_pylist() if number else [[]] * part.num_rows
                    spans = [
                        [*known, *({"entity": "PERSON", "start": a, "stop": b, "score": NAME_SCORE} for a, b in find(t or ""))]
                        for known, t in zip(before, part.column(text).to_pylist())
                    ]
                    columns = part.columns[:-1] if number else part.columns
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind)], names=out.names)

        return run

    for number in range(count):
        documents = documents.mapInArrow(search(number), out)
    return documents


def finder_spans(make_finder: Callable[[], Finder]):
    """The spans of a finder that each task makes once, as a function of a text column.

    A finder that cannot be made, or fails, fails the job, and so whatever it writes.
    """

    @F.pandas_udf(pii.SPAN_TYPE)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = make_finder()
        for texts in batches:
            found = finder([t or "" for t in texts])
            if len(found) != len(texts):
                raise RedactionUnavailable("the finder did not answer for every text")
            rows = [[{"entity": "PERSON", "start": a, "stop": b, "score": float(s)} for a, b, s in own] for own in found]
            yield pd.Series(rows, dtype=object)

    return spans


def with_names(
    documents: DataFrame, names: DataFrame | None, finder: Callable[[], Finder] | None, column: str = "_names"
) -> DataFrame:
    """Adds ``column``: spans of names, row by row, before overlaps are resolved."""
    if names is None and finder is None:
        raise RedactionUnavailable("names are to be found but there is neither a list nor a finder")
    if names is not None:
        documents = with_listed(documents, names, column)
    else:
        documents = documents.withColumn(column, F.expr(pii.EMPTY_SPANS))
    if finder is not None:
        documents = documents.withColumn(column, F.concat(F.col(column), finder_spans(finder)(F.col("text"))))
    return documents


def redact_person_names(
    documents: DataFrame, names: DataFrame | None = None, finder: Callable[[], Finder] | None = None
) -> DataFrame:
    """Spans of names: those that ``names(name)`` lists, and those that a finder finds.

    Listed are full names or single names, of any number of tokens; one is found as
    it stands in the text, white space of any length and kind as one blank. Work is
    linear in the text, whatever the length of the names. A ``finder`` is made once
    per task by calling it, and is the place for a language model. Of overlapping
    spans the surer stays, then the longer, so a name hides the shorter ones within it.
    """
    found = with_names(documents.select("doc_key", "text"), names, finder)
    return (
        found.select("doc_key", F.explode_outer(pii.resolve_spans(F.col("_names"))).alias("s"))
        .filter(F.col("s").isNotNull())
        .select("doc_key", "s.entity", "s.start", "s.stop", "s.score")
    )


def redaction_audit(documents: DataFrame) -> DataFrame:
    """Hits by entity, extractor and language with subtotals; never the values.

    Takes redacted documents (``entity_counts``); a NULL in a grouping column
    marks a subtotal over it. ``CARD_SHAPE_ONLY`` counts numbers that stayed.
    """
    shapes = F.when(
        F.col("card_shapes") > 0, F.create_map(F.lit("CARD_SHAPE_ONLY"), F.col("card_shapes"))
    ).otherwise(F.expr("CAST(map() AS map<string,int>)"))
    hits = (
        documents.select("extractor", "lang", F.map_concat("entity_counts", shapes).alias("counts"))
        .select("extractor", "lang", F.explode_outer("counts").alias("entity", "n"))
        .filter(F.col("entity").isNotNull())
    )
    return hits.rollup("entity", "extractor", "lang").agg(
        F.sum("n").alias("hits"), F.count(F.lit(1)).alias("documents")
    )


def names_missing(
    settings: RedactionSettings, names: DataFrame | None, finder: Callable[[], Finder] | None, required: bool | None
) -> bool:
    """Whether names are to be redacted but nothing can find them."""
    if required is None:
        required = "PERSON" in settings.entities
    return required and finder is None and (names is None or "name" not in names.columns or names.isEmpty())


def redaction_gate(
    documents: DataFrame,
    settings: RedactionSettings = DEFAULT,
    names: DataFrame | None = None,
    names_required: bool | None = None,
    finder: Callable[[], Finder] | None = None,
) -> DataFrame:
    """Fail closed: no write may get past this with personal data in it.

    Before any work: with redaction on there must be rules for the configured
    entities, and, while ``PERSON`` is one of them, names or a finder
    (``names_required`` says otherwise). In the plan: each row is looked at again, and
    one that still matches a rule raises, so the writing job aborts and its committer
    publishes nothing. ``check_staged`` looks at written files.
    """
    if not settings.enabled:
        return documents
    if not pii.active_rules(settings):
        raise RedactionUnavailable("redaction is on but there is no rule to apply")
    if names_missing(settings, names, finder, names_required):
        raise RedactionUnavailable("redaction is on but the list of names is missing or empty")
    message = F.concat(F.lit("personal data left in document "), F.col("doc_key").cast("string"))
    return once(
        documents,
        F.size(pii.text_spans(F.col("text"), settings)),
        lambda left: {"text": F.when(left > 0, F.raise_error(message)).otherwise(F.col("text"))},
    )


def check_staged(
    settings: RedactionSettings = DEFAULT,
    names: DataFrame | None = None,
    names_required: bool | None = None,
    finder: Callable[[], Finder] | None = None,
) -> Callable[[DataFrame], None]:
    """The check of staged files (doc_key, text), for ``publish_documents``.

    Counts the documents that still match a rule or hold a name, and raises if there
    are any. It reads what was written, not the plan that wrote it.
    """

    def check(staged: DataFrame) -> None:
        if not settings.enabled:
            return
        if not pii.active_rules(settings) or names_missing(settings, names, finder, names_required):
            raise RedactionUnavailable("redaction is on but its rules or names are missing")
        left = staged.filter(F.size(pii.text_spans(F.col("text"), settings)) > 0).select("doc_key")
        if "PERSON" in settings.entities and (names is not None or finder is not None):
            left = left.unionByName(redact_person_names(staged.select("doc_key", "text"), names, finder).select("doc_key"))
        count = left.distinct().count()
        if count:
            raise RedactionUnavailable(f"personal data left in {count} staged documents")

    return check
