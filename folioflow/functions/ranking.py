"""Positions and carried values in groups of any size.

A window over a whole group sorts that group in one task. Here the group is cut
by a ``bucket`` that never decreases in the order column; windows run per
bucket, and what crosses buckets is carried over a table of one small row per
(group, bucket). Exact, for any cut. ``stretches`` makes an even cut of any data: ranges
of the order itself, so a group that holds nearly all rows lies in nearly all ranges.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.session import new_run_folder

STRETCH = "_stretch"


def stretches(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``df`` with its even ranges of (keys, order), numbered in ``_stretch``.

    Written to the shared folder, as bounds are drawn from a sample and must be the
    same wherever the table is read.
    """
    spark = df.sparkSession
    folder = new_run_folder(spark, "stretches")
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(count, *[F.col(k) for k in keys], *order).withColumn(STRETCH, F.spark_partition_id())
    cut.write.parquet(folder)
    return spark.read.schema(cut.schema).parquet(folder)


def position_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], bucket: Column) -> DataFrame:
    """Adds ``position``: 1-based place within ``keys`` by ``order``."""
    cut = df.withColumn("_bucket", bucket)
    counts = cut.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return (
        matched(cut, offsets, [*keys, "_bucket"])
        .withColumn("position", F.row_number().over(inside) + F.col("_before"))
        .drop("_bucket", "_before")
    )


def last_before(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], bucket: Column, value: Column, name: str
) -> DataFrame:
    """Adds ``name``: the last non-NULL ``value`` at or before each row."""
    cut = df.withColumn("_bucket", bucket).withColumn("_value", value)
    inside = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    latest = cut.groupBy(*keys, "_bucket").agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct(*order))).alias("_latest")
    )
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.select(
        *keys, "_bucket", F.last("_latest", ignorenulls=True).over(before).alias("_carried")
    )
    return (
        matched(cut, carried, [*keys, "_bucket"])
        .withColumn(
            name, F.coalesce(F.last("_value", ignorenulls=True).over(inside), F.col("_carried"))
        )
        .drop("_bucket", "_value", "_carried")
    )


def matched(rows: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the columns of ``small``; a NULL key meets a NULL key."""
    named = small.withColumnsRenamed({k: f"_at_{k}" for k in keys})
    same = reduce(and_, [rows[k].eqNullSafe(named[f"_at_{k}"]) for k in keys])
    return rows.join(named, same).drop(*[f"_at_{k}" for k in keys])
