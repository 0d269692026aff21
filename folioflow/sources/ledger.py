"""Which batches of a table count.

A table's rows lie in one folder for each batch, and a batch counts once its record
is in the ledger. A record is written beside the ledger and then renamed into it, so
it is there as a whole or not at all. What a batch that failed has left is not read,
and is replaced when the batch comes again.
"""

from __future__ import annotations

import json
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _at(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    files, hadoop = _at(spark, path)
    return files.exists(hadoop)


def remove(spark: SparkSession, path: str) -> None:
    files, hadoop = _at(spark, path)
    files.delete(hadoop, True)


def committed(spark: SparkSession, table: str) -> list[str]:
    """Ids of the batches that count, sorted. A record for each, so as many as batches."""
    files, hadoop = _at(spark, f"{table}/_ledger")
    if not files.exists(hadoop):
        return []
    names = [status.getPath().getName() for status in files.listStatus(hadoop)]
    return sorted(unquote(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def commit(spark: SparkSession, table: str, batch: str, **told) -> bool:
    """Let a batch count; False where it did already."""
    files, record = _at(spark, f"{table}/_ledger/{quote(batch, safe='')}.json")
    if files.exists(record):
        return False
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table}/_drafts/{quote(batch, safe='')}.json")
    files.mkdirs(record.getParent())
    out = files.create(draft, True)
    try:
        out.write(bytearray(json.dumps({"batch": batch, **told}).encode()))
    finally:
        out.close()
    return files.rename(draft, record)


def batch_folder(table: str, batch: str, part: str = "data") -> str:
    return f"{table}/{part}/batch={quote(batch, safe='')}"


def read(spark: SparkSession, table: str, schema: str, part: str = "data") -> DataFrame:
    """Rows of the batches that count, with ``batch`` as their last column.

    A table may have several parts that are committed together.
    """
    batches = committed(spark, table)
    if not batches or not exists(spark, f"{table}/{part}"):
        return spark.createDataFrame([], f"{schema}, batch STRING")
    rows = spark.read.schema(f"{schema}, batch STRING").parquet(f"{table}/{part}")
    # One short row a batch; folders of others are pruned.
    listed = spark.createDataFrame([(b,) for b in batches], "batch STRING")
    return rows.join(F.broadcast(listed), "batch", "left_semi").select(*rows.columns)
