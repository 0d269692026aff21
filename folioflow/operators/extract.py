"""Extraction results, form blocks and sheets as plain text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow import schemas
from folioflow.functions.plan import once
from folioflow.functions.text import join_parts, ordered_text, strip


def flatten_results(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, errors) from (doc_key, segments_json).

    Per segment: audio transcript, video transcript, chapter summaries, pages
    (markdown if it is not empty, else text), image summary, image lines. Row
    by row. JSON that is not a list of segments goes to errors, never on as
    blank text.
    """
    none = F.expr("CAST(array() AS array<string>)")

    def one(segment):
        def listed(column, pick):
            return F.coalesce(F.transform(column, pick), none)

        return F.concat(
            F.array(
                segment["audio"]["transcript"]["representation"]["text"],
                segment["video"]["transcript"]["representation"]["text"],
            ),
            listed(segment["chapters"], lambda c: c["summary"]),
            listed(
                segment["pages"],
                lambda p: F.coalesce(
                    F.nullif(p["representation"]["markdown"], F.lit("")), p["representation"]["text"]
                ),
            ),
            F.array(segment["image"]["summary"]),
            listed(segment["image"]["text_lines"], lambda line: line["text"]),
        )

    carried = [c for c in results.columns if c != "segments_json"]
    parsed = once(
        results,
        F.from_json("segments_json", schemas.SEGMENTS),
        lambda segments: {"text": join_parts(F.flatten(F.transform(segments, one)))},
    )
    documents = parsed.filter(F.col("text").isNotNull()).select(*carried, "text")
    errors = parsed.filter(F.col("text").isNull()).select(
        *carried, F.lit("extraction result is not readable").alias("reason")
    )
    return documents, errors


def form_fields(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs) from a form's block graph, kept as an edge table.

    Keys meet their value block, and both meet their words, by equi-joins on
    (doc_key, id). Words keep child order; a selected box reads ``[X]``. Of
    several value links the last counts; keys without words are dropped. A form with
    neither lines nor fields has an empty text.
    """
    key_blocks = blocks.filter(
        (F.col("block_type") == "KEY_VALUE_SET") & F.array_contains("entity_types", "KEY")
    )
    value_ids = F.flatten(
        F.transform(F.filter("relationships", lambda r: r["type"] == "VALUE"), lambda r: r["ids"])
    )
    sides = key_blocks.select(
        "doc_key",
        F.col("pos").alias("key_pos"),
        F.explode(
            F.array(
                F.struct(F.lit("key").alias("side"), F.col("id").alias("block_id")),
                F.struct(
                    F.lit("value").alias("side"), F.try_element_at(value_ids, F.lit(-1)).alias("block_id")
                ),
            )
        ).alias("s"),
    ).select("doc_key", "key_pos", "s.side", "s.block_id")
    linked = blocks.filter(F.size("relationships") > 0).select(
        "doc_key",
        F.col("id").alias("block_id"),
        F.flatten(
            F.transform(F.filter("relationships", lambda r: r["type"] == "CHILD"), lambda r: r["ids"])
        ).alias("child_ids"),
    )
    edges = sides.join(linked, ["doc_key", "block_id"]).select(
        "doc_key", "key_pos", "side", F.posexplode("child_ids").alias("child_no", "id")
    )
    tokens = blocks.filter(
        (F.col("block_type") == "WORD")
        | ((F.col("block_type") == "SELECTION_ELEMENT") & (F.col("selection_status") == "SELECTED"))
    ).select(
        "doc_key", "id", F.when(F.col("block_type") == "WORD", F.col("text")).otherwise("[X]").alias("word")
    )
    in_order = lambda side: F.array_join(
        F.transform(
            F.sort_array(F.collect_list(F.when(F.col("side") == side, F.struct("child_no", "word")))),
            lambda t: t["word"],
        ),
        " ",
    )
    pairs = (
        edges.join(tokens, ["doc_key", "id"])
        .groupBy("doc_key", "key_pos")
        .agg(in_order("key").alias("key"), in_order("value").alias("value"))
        .filter(F.col("key") != "")
    )
    lines = blocks.filter(F.col("block_type") == "LINE").select(
        "doc_key", F.lit(0).alias("part"), F.col("pos"), F.col("text").alias("line")
    )
    fields = pairs.select(
        "doc_key",
        F.lit(1).alias("part"),
        F.col("key_pos").alias("pos"),
        strip(F.concat_ws(" ", "key", "value")).alias("line"),
    )
    part_text = lambda n: F.array_join(
        F.transform(
            F.sort_array(F.collect_list(F.when(F.col("part") == n, F.struct("pos", "line")))),
            lambda t: t["line"],
        ),
        "\n",
    )
    every = blocks.select("doc_key").distinct().select(
        "doc_key", F.lit(2).alias("part"), F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("line")
    )
    documents = (
        lines.unionByName(fields)
        .unionByName(every)
        .groupBy("doc_key")
        .agg(part_text(0).alias("lines"), part_text(1).alias("fields"))
        .select(
            "doc_key",
            F.concat_ws(
                "\n\n",
                F.when(strip(F.col("lines")) != "", F.col("lines")),
                F.when(F.col("fields") != "", F.concat(F.lit("Form fields:\n"), "fields")),
            ).alias("text"),
        )
    )
    return documents, pairs


def sheets_to_text(sheet_cells: DataFrame) -> DataFrame:
    """(doc_key, text) from (doc_key, sheet_no, sheet_name, row_no, cells).

    Row 0 of a sheet is its header; a sheet without further rows is skipped, and a
    workbook of such sheets has an empty text. Cells are quoted, and rows joined,
    before anything is shuffled. Rows are dealt by workbook, which serves both steps.
    """

    def quoted(cell):
        return F.when(
            cell.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))
        ).otherwise(F.coalesce(cell, F.lit("")))

    row = F.array_join(F.transform("cells", quoted), ",")
    only_empty = (F.size("cells") == 1) & (F.coalesce(F.get("cells", F.lit(0)), F.lit("")) == "")
    rows = sheet_cells.select(
        "doc_key", "sheet_no", "sheet_name", "row_no", F.when(only_empty, '""').otherwise(row).alias("row")
    )
    titled = F.concat(F.lit("## Sheet: "), "sheet_name", F.lit("\n\n"), strip(F.col("csv")))
    sheets = (
        rows.repartition("doc_key")
        .groupBy("doc_key", "sheet_no", "sheet_name")
        .agg(ordered_text(F.col("row_no"), F.col("row"), "\n").alias("csv"), F.count(F.lit(1)).alias("n"))
        .select("doc_key", "sheet_no", F.when(F.col("n") > 1, titled).alias("sheet"))
    )
    return sheets.groupBy("doc_key").agg(
        ordered_text(F.col("sheet_no"), F.col("sheet"), "\n\n").alias("text")
    )


def frame_as_sheet(df: DataFrame, doc_key, sheet_no: int, sheet_name, order, columns: list[str]) -> DataFrame:
    """Any frame as sheet cells: its rows by ``order``, under a header row.

    ``doc_key`` names the column that says which workbook a row belongs to.
    Row numbers only have to be in order, so no window is needed.
    """
    body = df.select(
        F.col(doc_key).cast("string").alias("doc_key"),
        F.lit(sheet_no).alias("sheet_no"),
        F.lit(sheet_name).alias("sheet_name"),
        F.col(order).cast("bigint").alias("row_no"),
        F.array(*[F.col(c).cast("string") for c in columns]).alias("cells"),
    )
    header = (
        body.select("doc_key", "sheet_no", "sheet_name")
        .distinct()
        .withColumn("row_no", F.lit(-1).cast("bigint"))
        .withColumn("cells", F.array(*[F.lit(c) for c in columns]))
    )
    return header.unionByName(body)
