"""Packing of documents into token sequences of a fixed capacity.

A document is its ids and an end id. Only one that is longer than a sequence is
cut, into pieces of the full capacity behind a first piece that may be shorter.

Method, large items first: a sequence holds at most two pieces of more than a
third of the capacity, so these are matched greedily, the longest with the longest
partner that still fits. Shorter pieces then go, longest first, into the sequence
with the least gap that holds them.

Pieces of one length are alike, so the matching is made over how many there are of
each length: at most ``capacity`` counts, whatever the size of the corpus. It says
that the pieces of a length with ranks from r on go to sequences from s on, so many
to each. Ranks are found on Spark, per stretch of a length, so a length that a third
of all pieces have is no single group. Texts are never shuffled.

Defined results: a NULL or empty text is the end id alone; repeated rows are packed
each; a NULL id is carried; other columns are ignored; no rows give no pieces.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from folioflow.functions.ranking import position_in_group
from folioflow.llm.batches import free_name, raw_texts, slices
from folioflow.llm.bpe_trie import FROM_BYTES, TO_BYTES
from folioflow.session import new_run_folder

CAPACITY = 2_048
#: Fixed value: the pieces that byte-level tokenizers cut a text into.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_RUN = re.compile(r"\S{1000}|\s{1000}")
WINDOW = 500
BYTE_LETTERS = {chr(TO_BYTES.get(b, b)) for b in range(256)}


class Run(NamedTuple):
    """Pieces of ``length`` with ranks from ``rank`` to below ``end``: ``each`` to a sequence."""

    length: int
    rank: int
    end: int
    each: int
    sequence: int
    offset: int


def byte_ranks(content: dict) -> dict[bytes, int] | None:
    """Ids of a byte-level vocabulary by their bytes, if its merges go by id; else None."""
    vocabulary, merges = content["model"]["vocab"], content["model"]["merges"]
    made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
    if made != sorted(made):
        return None
    return {token.translate(FROM_BYTES).encode("latin-1"): i for token, i in vocabulary.items() if set(token) <= BYTE_LETTERS}


def has_long_run(text: str) -> bool:
    """Whether a text may hold a run of 1,000 characters without a blank, or of white space.

    Such a run fills a whole window, so most texts are told by their windows.
    """
    windows = (text[i : i + WINDOW] for i in range(0, len(text) - WINDOW + 1, WINDOW))
    return any(" " not in w or w.isspace() for w in windows) and bool(LONG_RUN.search(text))


class Encoder:
    """Ids of a text, as bytes, as the tokenizers library gives them for a file.

    Where the merges of the file go by id, a merger by ranks gives the same ids some
    times faster. It gets the file's own vocabulary, and texts without very long runs,
    which it is not made for; the library gets all others.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.path, self.library = path, None
        self.specials = {t["content"]: t["id"] for t in content["added_tokens"]}
        ranks = byte_ranks(content) if content["pre_tokenizer"]["type"] == "ByteLevel" else None
        for special in self.specials:
            (ranks or {}).pop(special.encode(), None)
        self.fast = ranks and tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.specials)

    def slow(self, text: str) -> bytes:
        if self.library is None:
            # Threads and caches of the library outlive a task; neither is of use here.
            self.library = Tokenizer.from_file(self.path)
            self.library.model._resize_cache(0)
            self.library.no_truncation()
            self.library.no_padding()
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str) -> bytes:
        if self.fast is None or has_long_run(text):
            return self.slow(text)
        return self.fast.encode_to_numpy(text, allowed_special=set(self.specials), disallowed_special=()).tobytes()


def cut_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document; only the first may be short of the capacity."""
    first = (total - 1) % capacity + 1
    return [first, *[capacity] * ((total - first) // capacity)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row, and ``ids`` if asked for.

    ``path`` is the tokenizer's file, at the same place on every worker; ``ids``
    are little-endian unsigned 32-bit integers.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias(free_name(docs, "_text")))
    new = "piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT" + ", ids BINARY" * with_ids
    schema = StructType([rows.schema["doc_id"], *StructType.fromDDL(new).fields])
    arrow = to_arrow_schema(schema)
    last = struct.pack("<I", end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path)
        for part in slices(batches):
            owners, values = [], []
            for row, raw in enumerate(raw_texts(part.column(1))):
                ids = (encode(raw.decode("utf-8", "replace")) if raw else b"") + last
                start = 0
                for number, length in enumerate(cut_lengths(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    values.append((number, start, length, zlib.crc32(own), own)[: 4 + with_ids])
                    owners.append(row)
                    start += length
            columns = list(zip(*values)) if values else [()] * (4 + with_ids)
            carried = part.column(0).take(pa.array(owners, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [carried.cast(arrow.field(0).type), *map(pa.array, columns, arrow.types[1:])], schema=arrow
            )

    return rows.mapInArrow(cut, schema)


def plan_runs(counts: dict[int, int], capacity: int) -> list[Run]:
    """Where the pieces go, from the number of pieces of each length.

    Sequences that are filled alike are kept together, so the work depends on the
    number of lengths and not on the number of pieces.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    placed = dict.fromkeys(left, 0)
    runs: list[Run] = []
    gaps: dict[int, deque[tuple[int, int]]] = {}  # gap: (first sequence, number of them)
    by_size: list[int] = []
    used = 0

    def place(length: int, n: int, each: int, sequence: int, offset: int) -> None:
        runs.append(Run(length, placed[length], placed[length] + n, each, sequence, offset))
        placed[length] += n
        left[length] -= n

    def leave(gap: int, sequence: int, n: int) -> None:
        if gap not in gaps:
            gaps[gap] = deque()
            insort(by_size, gap)
        gaps[gap].append((sequence, n))

    large = sorted((x for x in left if 3 * x > capacity), reverse=True)
    for length in large:
        while left[length]:
            room = capacity - length
            partner = next((x for x in large if x <= room and left[x] - (x == length) > 0), None)
            if partner is None:
                n = left[length]
                place(length, n, 1, used, 0)
                leave(room, used, n)
            else:
                n = left[length] // 2 if partner == length else min(left[length], left[partner])
                place(length, n, 1, used, 0)
                place(partner, n, 1, used, length)
                leave(room - partner, used, n)
            used += n

    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(by_size, length)
            if at == len(by_size):
                leave(capacity, used, -(-left[length] // (capacity // length)))
                used += gaps[capacity][-1][1]
                continue
            gap = by_size[at]
            sequence, n = gaps[gap].popleft()
            if not gaps[gap]:
                del gaps[gap], by_size[at]
            each = min(gap // length, left[length])
            full = min(n, left[length] // each)
            place(length, full * each, each, sequence, capacity - gap)
            leave(gap - each * length, sequence, full)
            if full < n:
                leave(gap, sequence + full, n - full)
    return runs


def placed(rows: DataFrame, runs: list[Run]) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` by ``length`` and ``position`` (from 1).

    The runs are a table whose size depends on the capacity alone.
    """
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, len(Run._fields))
    lengths, ranks, _, each, sequences, offsets = table.T
    shared = rows.sparkSession.sparkContext.broadcast((lengths, ranks, each, sequences, offsets))

    @F.pandas_udf("sequence_id BIGINT, offset BIGINT")
    def spot(length: pd.Series, position: pd.Series) -> pd.DataFrame:
        lengths, ranks, each, sequences, offsets = shared.value
        size, rank = length.to_numpy(np.int64), position.to_numpy(np.int64) - 1
        low, high = np.searchsorted(lengths, size), np.searchsorted(lengths, size, side="right")
        while (low + 1 < high).any():  # the last run of the length that starts at or before the rank
            middle = (low + high) // 2
            before = ranks[np.minimum(middle, len(ranks) - 1)] <= rank
            low, high = np.where(before, middle, low), np.where(before, high, middle)
        inside = rank - ranks[low]
        return pd.DataFrame(
            {"sequence_id": sequences[low] + inside // each[low], "offset": offsets[low] + inside % each[low] * size}
        )

    return rows.withColumn("_spot", spot("length", "position")).select(
        *[c for c in rows.columns if c != "position"], "_spot.sequence_id", "_spot.offset"
    )


def pack_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False
) -> DataFrame:
    """The pieces of all documents with their ``sequence_id`` and ``offset`` in it.

    The pieces are written to the shared folder first: they are counted and then
    ranked, and texts are encoded once.
    """
    spark = docs.sparkSession
    folder = new_run_folder(spark, "packing")
    pieces(docs, path, capacity, end_id, with_ids).write.parquet(folder)
    cut = spark.read.parquet(folder)
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return cut.withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")})
    stretches = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stretch = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(stretches))
    ranked = position_in_group(cut, ["length"], [F.col("doc_id"), F.col("piece")], stretch)
    return placed(ranked, plan_runs(counts, capacity))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids, doc_ids, starts) of packed pieces that carry ids.

    A group is one sequence, so it has at most as many rows as the capacity.
    """
    part = F.struct("offset", "doc_id", "length", "ids")
    return (
        packed.groupBy("sequence_id")
        .agg(F.sum("length").alias("length"), F.array_sort(F.collect_list(part)).alias("_parts"))
        .select(
            "sequence_id",
            "length",
            F.aggregate(F.col("_parts.ids"), F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"),
            F.col("_parts.doc_id").alias("doc_ids"),
            F.col("_parts.offset").alias("starts"),
        )
    )
