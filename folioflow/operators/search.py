"""Ranked retrieval for a table of queries.

Terms: a scan adds up, group of rows by group of rows, the products of frequencies with
blocks of queries, which tasks read from the shared folder as postings by term. The work
is that of an equi-join on the term, but neither terms nor products leave the task: of a
group, the best ``k`` rows of a query do. Rows are added up by id first, and only those
of repeated ids are shuffled for that.

Vectors: a scan scores batches of rows against blocks of queries, which tasks read from
the shared folder block by block, so memory has a bound whatever the number of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from folioflow.session import new_run_folder

#: Rows and queries whose products are held at a time.
GROUP_ROWS = 20_000
QUERY_ROWS = 256
#: The same for rows of terms, with the terms and products that are held at a time, and
#: the blocks of queries that a task keeps.
TERM_ROWS = 8_192
TERMS_AT_ONCE = 1_000_000
QUERY_TERMS = 200_000
PRODUCTS = 4_000_000
BLOCKS_KEPT = 8


def best(scored: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query of (query_id, id, score): score, then the lower id."""
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    return scored.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)


# --- Terms ----------------------------------------------------------------------


def one_row_per_id(rows: DataFrame) -> DataFrame:
    """(id, terms, tfs) of (id, terms): rows of one id are added up.

    ``tfs`` counts each of ``terms``, and is NULL where every one of them counts once.
    The table is written, so that its ids are looked at without making the terms
    again, and only rows of ids that come several times are shuffled.
    """
    spark = rows.sparkSession
    folder = new_run_folder(spark, "terms")
    rows.select("id", "terms").write.parquet(f"{folder}/rows")
    kept = spark.read.schema(rows.select("id", "terms").schema).parquet(f"{folder}/rows")
    repeated = kept.groupBy(F.col("id").alias("_id")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    repeated.select("_id").write.parquet(f"{folder}/repeated")
    repeated = spark.read.schema(repeated.select("_id").schema).parquet(f"{folder}/repeated")
    once = F.lit(None).cast("array<bigint>")
    if repeated.isEmpty():
        return kept.withColumn("tfs", once)
    same = kept["id"].eqNullSafe(repeated["_id"])
    counted = (
        kept.join(repeated, same, "left_semi")
        .select("id", F.explode("terms").alias("term"))
        .groupBy("id", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
        .groupBy("id")
        .agg(F.collect_list(F.struct("term", "tf")).alias("p"))
    )
    summed = counted.select("id", F.transform("p", lambda p: p["term"]).alias("terms"), F.transform("p", lambda p: p["tf"]).alias("tfs"))
    return kept.join(repeated, same, "left_anti").withColumn("tfs", once).unionByName(summed)


class Postings:
    """Rows of (id, terms, tfs) in the order of their ids, as counts of distinct terms."""

    def __init__(self, table: pa.Table) -> None:
        table = table.take(pc.sort_indices(table, sort_keys=[("id", "ascending")], null_placement="at_start")).combine_chunks()
        self.ids = table.column("id").combine_chunks()
        terms = table.column("terms").combine_chunks()
        sizes = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False)
        coded = pc.dictionary_encode(terms.flatten(), null_encoding="encode")
        self.terms = coded.dictionary
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        width = max(1, len(self.terms))
        places = np.repeat(np.arange(len(sizes)), sizes) * width + codes
        tfs = table.column("tfs").combine_chunks()
        if tfs.null_count == len(tfs):
            places, self.tf = np.unique(places, return_counts=True)
        else:
            given = pc.list_value_length(tfs).is_valid().to_numpy(zero_copy_only=False)
            counts = np.ones(len(places), np.int64)
            counts[np.repeat(given, sizes)] = tfs.flatten().to_numpy(zero_copy_only=False)
            places, at = np.unique(places, return_inverse=True)
            self.tf = np.zeros(len(places), np.int64)
            np.add.at(self.tf, at, counts)
        self.row, self.code = np.divmod(places, width)
        self.norm2 = np.bincount(self.row, self.tf * self.tf, len(sizes)).astype(np.int64)

    def by_term(self) -> Postings:
        """The same, for looking up the rows of a term."""
        order = np.argsort(self.code, kind="stable")
        self.row, self.tf, codes = self.row[order], self.tf[order], self.code[order]
        self.begins = np.searchsorted(codes, np.arange(len(self.terms) + 1))
        return self

    def dots(self, asked: Postings) -> np.ndarray:
        """(queries, rows): sums of products of frequencies; whole numbers, so they are exact."""
        place = pc.index_in(self.terms, value_set=asked.terms).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        place[np.flatnonzero(self.terms.is_null().to_numpy(zero_copy_only=False))] = -1
        own = place[self.code]
        met = own >= 0
        row, tf, own = self.row[met], self.tf[met], own[met]
        first, times = asked.begins[own], asked.begins[own + 1] - asked.begins[own]
        until, out = np.cumsum(times), np.zeros((len(asked.ids), len(self.ids)))
        start = 0
        while start < len(row):
            before = until[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(until, before + PRODUCTS, side="right")))
            if stop < len(row):  # whole rows, but for one that has more by itself
                stop = int(np.searchsorted(row, row[stop], side="left")) if row[stop] > row[start] else stop
            part, low, high = slice(start, stop), row[start], row[stop - 1] + 1
            n = times[part]
            at = np.arange(n.sum()) + np.repeat(first[part] - (np.cumsum(n) - n), n)
            cells = asked.row[at] * (high - low) + np.repeat(row[part] - low, n)
            sums = np.bincount(cells, np.repeat(tf[part], n) * asked.tf[at], len(asked.ids) * (high - low))
            out[:, low:high] += sums.reshape(len(asked.ids), high - low)
            start = stop
        return out


def groups_of(batches: Iterator[pa.RecordBatch], rows: int, terms: int) -> Iterator[pa.Table]:
    """The batches as tables of at most so many rows, and of so many terms or one row."""
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("terms")), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            room = rows - sum(b.num_rows for b in waiting)
            stop = min(start + room, int(np.searchsorted(ends, before + terms - held, side="right")))
            if stop <= start and not waiting:
                stop = start + 1
            if stop > start:
                waiting.append(batch.slice(start, stop - start))
                held += int(ends[stop - 1] - before)
                start = stop
            if start < batch.num_rows:
                yield pa.Table.from_batches(waiting)
                waiting, held = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def best_by_terms(queries: DataFrame, rows: DataFrame, k: int, cosine: bool) -> DataFrame:
    """The ``k`` best rows of each query among those that share a term with it."""
    spark = rows.sparkSession
    folder = f"{new_run_folder(spark, 'query-postings')}/rows"
    one_row_per_id(queries).write.parquet(folder)
    q_type, i_type = queries.schema["id"].dataType, rows.schema["id"].dataType
    schema = pa.schema([("query_id", to_arrow_type(q_type)), ("id", to_arrow_type(i_type)), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        asked = pyarrow.dataset.dataset(root, filesystem=files)
        known: list[Postings] = []

        def blocks() -> Iterator[Postings]:
            if known:
                yield from known
                return
            number = 0
            for block in groups_of(asked.to_batches(batch_size=QUERY_ROWS), QUERY_ROWS, QUERY_TERMS):
                made = Postings(block).by_term()
                number += 1
                known.append(made)
                if number > BLOCKS_KEPT:
                    known.clear()
                yield made

        for group in groups_of(batches, TERM_ROWS, TERMS_AT_ONCE):
            held = Postings(group)
            for block in blocks():
                scores = held.dots(block)
                scores[scores == 0] = -np.inf
                if cosine:
                    scores /= np.sqrt((block.norm2[:, None] * held.norm2[None, :]).astype(np.float64))
                n = scores.shape[1]
                floor = np.partition(scores, n - k, axis=1)[:, n - k] if n > k else np.full(len(scores), -np.inf)
                q, r = [], []
                for number, (own, least) in enumerate(zip(scores, floor)):
                    near = np.flatnonzero((own >= least) & (own > -np.inf))  # by id, as the rows are
                    near = near[np.argsort(-own[near], kind="stable")][:k]
                    q.append(np.full(len(near), number))
                    r.append(near)
                at_q, at_r = np.concatenate(q), np.concatenate(r)
                yield pa.RecordBatch.from_arrays(
                    [
                        block.ids.take(pa.array(at_q, pa.int64())).cast(schema.field(0).type),
                        held.ids.take(pa.array(at_r, pa.int64())).cast(schema.field(1).type),
                        pa.array(scores[at_q, at_r]),
                    ],
                    schema=schema,
                )

    out = f"query_id {q_type.simpleString()}, id {i_type.simpleString()}, score double"
    return best(one_row_per_id(rows).mapInArrow(score, out), k)


def search_hashed(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, id, score, rank): top ``k`` by cosine over hashed term vectors.

    Both sides as (id, terms), see ``hash_vectors``. Ties by the lower id; only rows
    that share a term with the query are ranked.
    """
    return best_by_terms(queries, vectors, k, cosine=True)


def search_terms(queries: DataFrame, texts: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` by sum of term products; with distinct terms on both sides that
    is the number of query terms a row holds. Both sides as (id, terms)."""
    return best_by_terms(queries, texts, k, cosine=False)


# --- Vectors ----------------------------------------------------------------------


def as_matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit(matrix: np.ndarray) -> np.ndarray:
    norm = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    norm[norm == 0] = 1.0
    return matrix / norm


def best_of_group(scores: np.ndarray, ids: list, k: int) -> tuple[list[int], list[int]]:
    """(query, row) places of the best ``k`` rows of each column; ties by the lower id."""
    n = len(ids)
    floor = np.partition(scores, n - k, axis=0)[n - k] if n > k else np.full(scores.shape[1], -np.inf)
    queries, rows = [], []
    for q in range(scores.shape[1]):
        near = np.flatnonzero(scores[:, q] >= floor[q]).tolist()
        near.sort(key=lambda r: (-scores[r, q], ids[r]))
        queries += [q] * min(k, len(near))
        rows += near[:k]
    return queries, rows


def search_vectors(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, id, score, rank): top ``k`` by cosine over dense vectors.

    Both sides as (id, vector). Scores are rounded to 6 places before they are
    ranked, which keeps near-ties in the same order on any machine.
    """
    spark = vectors.sparkSession
    folder = f"{new_run_folder(spark, 'query-vectors')}/rows"
    queries.select("id", "vector").write.parquet(folder)
    q_type, i_type = queries.schema["id"].dataType, vectors.schema["id"].dataType
    schema = pa.schema([("query_id", to_arrow_type(q_type)), ("id", to_arrow_type(i_type)), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        asked = pyarrow.dataset.dataset(root, filesystem=files)

        def group(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = pa.Table.from_batches(parts)
            ids, matrix = held.column("id").to_pylist(), unit(as_matrix(held.column("vector")))
            for block in asked.to_batches(batch_size=QUERY_ROWS):
                if block.num_rows:
                    scores = np.round(matrix @ unit(as_matrix(block.column("vector"))).T, 6)
                    q, r = best_of_group(scores, ids, k)
                    yield pa.RecordBatch.from_arrays(
                        [
                            block.column("id").take(pa.array(q, pa.int64())).cast(schema.field(0).type),
                            held.column("id").combine_chunks().take(pa.array(r, pa.int64())).cast(schema.field(1).type),
                            pa.array(scores[r, q]),
                        ],
                        schema=schema,
                    )

        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= GROUP_ROWS:
                yield from group(waiting)
                waiting = []
        if waiting:
            yield from group(waiting)

    out = f"query_id {q_type.simpleString()}, id {i_type.simpleString()}, score double"
    return best(vectors.select("id", "vector").mapInArrow(score, out), k)


def cosine(left: Column, right: Column) -> Column:
    """Cosine of two vectors; 0 where one has no length."""

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)

    length = F.sqrt(dot(left, left)) * F.sqrt(dot(right, right))
    return F.when(length > 0, dot(left, right) / length).otherwise(F.lit(0.0))
