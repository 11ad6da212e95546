"""Connected components of links held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.storage import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node it is linked with over any number of links.

    Alternates two star steps: every node hands its larger neighbours, then its smaller
    ones, to the smallest node it knows, until each component is a star around its smallest
    node. Minima are combined before the shuffle, and the joins are on a node, where adaptive
    execution can split a hub. Each step is written to the shared folder, so a lost executor
    repeats one step only. Links with a null end are no links; nodes without links are absent.
    """
    edges = cut_lineage(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct(),
        "links",
    )
    # a node with several smaller neighbours, or a smallest node that has a smaller one, is not done
    while not edges.isEmpty() and not _stars(edges):
        edges = cut_lineage(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )


def _stars(edges: DataFrame) -> bool:
    several = edges.groupBy("hi").count().where("count > 1")
    chained = edges.join(edges.select(F.col("hi").alias("lo")), "lo", "left_semi")
    return several.isEmpty() and chained.isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    larger = both.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi > lo").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    joined = edges.join(least, "hi")
    return joined.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(least.select("hi", F.col("m").alias("lo"))).where("hi > lo").distinct()
