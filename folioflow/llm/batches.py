"""Running a text kernel over Arrow batches, inside the tasks that read the rows.

A kernel is made once per task by ``make()`` and is then called with a list of
texts as UTF-8 bytes (NULL stays None). Batches are cut into slices, so that a
task holds a bounded number and a bounded volume of texts as Python objects at a
time; a text that is larger by itself is a slice of its own.

A worker of Spark outlives its task, and the next one may belong to any other stage.
So batches reach it in bounded bytes, and what a kernel held goes back to the system
when its task ends.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

SLICE_ROWS = 512
SLICE_BYTES = 8_000_000
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

Kernel = Callable[[list[bytes | None]], object]


def raw_texts(column: pa.Array) -> list[bytes | None]:
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return column.cast(pa.large_binary() if large else pa.binary()).to_pylist()


def row_bytes(batch: pa.RecordBatch) -> np.ndarray:
    """Bytes of each row's texts."""
    total = np.zeros(batch.num_rows, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type):
            total += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    return total


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = np.cumsum(row_bytes(batch))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            full = int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))
            stop = min(start + rows, max(start + 1, full))
            yield batch.slice(start, stop - start)
            start = stop


def bound_batches(spark: SparkSession) -> None:
    """Batches on the way to Python hold ``SLICE_BYTES``, or one larger text, unless the
    session says otherwise: both the JVM and the worker hold one or two in each task."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(SLICE_BYTES))


def give_back() -> None:
    """Freed memory goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library alone
    if trim is not None:
        trim(0)


def leaving_nothing(run: Callable) -> Callable:
    """``run``, after whose last batch the worker holds no more than before."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return runs


def measure(
    docs: DataFrame, carried: list[str], text: str, make: Callable[[], Kernel], measured: str
) -> DataFrame:
    """``carried`` columns and the columns the kernel returns, one row per row.

    The kernel returns a dict of lists by the names in the DDL ``measured``.
    Only the named columns are read, so other columns never clash.
    """
    rows = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text}`").cast("string").alias(free_name(docs, "_text")))
    new = StructType.fromDDL(measured)
    schema = StructType(rows.schema.fields[:-1] + new.fields)
    names = [f.name for f in new.fields]
    kinds = {f.name: to_arrow_type(f.dataType) for f in new.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = make()
        for part in slices(batches):
            values = kernel(raw_texts(part.column(part.num_columns - 1)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], *[pa.array(values[n], kinds[n]) for n in names]],
                names=[*part.schema.names[:-1], *names],
            )

    bound_batches(docs.sparkSession)
    return rows.mapInArrow(leaving_nothing(run), schema)


def keep(docs: DataFrame, columns: list[str], make: Callable[[], Callable[..., list[bool]]]) -> DataFrame:
    """The rows, with all their columns, for which the kernel says True.

    The kernel gets one list for each of ``columns``: texts as bytes for the
    first, plain values for the others.
    """
    places = [docs.columns.index(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = make()
        for part in slices(batches):
            first, *others = places
            kept = kernel(raw_texts(part.column(first)), *[part.column(i).to_pylist() for i in others])
            yield part.filter(pa.array(kept, pa.bool_()))

    bound_batches(docs.sparkSession)
    return docs.mapInArrow(leaving_nothing(run), docs.schema)



def free_name(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until the frame has no such column."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name
