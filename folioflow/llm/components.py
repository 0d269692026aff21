"""Connected components of a graph of links, by alternating stars.

Each round sends every node's larger neighbours, then its smaller ones, to the
least node known near it. Minima are found by a grouped sum with map-side
combine and joined back, so a hub's links are never gathered in one task, and
the rounds grow with the logarithm of a component's size. Every round is
written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.session import new_run_folder


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in (a, b); root is the component's least node.

    Loops and repeated links do no harm; links with a NULL end are ignored.
    """
    spark = links.sparkSession
    folder = new_run_folder(spark, "components")
    edges = _written(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        f"{folder}/0",
    )
    number, before = 0, None
    while True:
        number += 1
        edges = _written(_small_star(_large_star(edges)), f"{folder}/{number}")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.join(least, "a")
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, are linked to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
