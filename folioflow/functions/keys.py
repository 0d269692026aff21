"""One row of each key, without moving the rows that are alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.session import new_run_folder


def one_per_key(rows: DataFrame, key: str, order: Sequence[Column], held: DataFrame | None = None) -> DataFrame:
    """Of the rows of each ``key`` the first by ``order``; none of a key in ``held``.

    Only keys are counted and shuffled. Keys with several rows, and those that are
    held, are two tables of keys, and rows meet them: by a broadcast where these are
    small, as they mostly are, and by a shuffle where they are not. Rows of a key
    that has several are brought together, and no others.
    """
    spark = rows.sparkSession
    folder = new_run_folder(spark, "keys")
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}"

    def written(keys: DataFrame, name: str) -> DataFrame:
        keys.select(key).write.parquet(f"{folder}/{name}")
        return spark.read.schema(schema).parquet(f"{folder}/{name}")

    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    if held is not None:
        known = written(counted.join(held.select(key).distinct(), key, "left_semi"), "held")
        rows = rows.join(known, key, "left_anti")
        counted = counted.join(known, key, "left_anti")
    repeated = written(counted.filter(F.col("_n") > 1), "repeated")
    several = rows.join(repeated, key, "left_semi").groupBy(key)
    others = [c for c in rows.columns if c != key]
    first = several.agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_row")).select(
        *[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in rows.columns]
    )
    return rows.join(repeated, key, "left_anti").select(*rows.columns).unionByName(first)
