"""Connected components of an edge table by alternating stars.

Large stars hang each node's larger neighbours on its smallest one, small stars
hang the smaller ones there too; the table becomes one star per component in a
number of rounds about the logarithm of the longest path. Each round is written
below ``spark.checkpoint.dir``, the one before it deleted. A hub's edges are joined to its minimum by a
plain equality of two written tables, which adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import discard, staged


def _minima(edges: DataFrame) -> DataFrame:
    return staged(edges.groupBy("u").agg(F.min("v").alias("m")), "minima")


def _large_stars(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    minima = _minima(both)
    least = minima.select("u", F.least("m", "u").alias("m"))
    moved = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    found = staged(moved.distinct(), "large-stars")
    discard(minima)
    return found


def _small_stars(edges: DataFrame) -> DataFrame:
    """``edges`` have u > v."""
    least = _minima(edges)
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    found = staged(moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "small-stars")
    discard(least)
    return found


def _print(edges: DataFrame) -> tuple:
    """Number and order-free checksum of the edges."""
    mark = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mark)).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: ids of one ordered type) -> node, component.

    A row for every node of an edge between two different, non-null ids;
    component is the smallest id reachable. Directions and repeats don't matter.
    """
    a, b = F.col("a"), F.col("b")
    clean = edges.where(a.isNotNull() & b.isNotNull() & (a != b))
    stars = staged(
        clean.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    seen, now = None, _print(stars)
    while seen != now:
        larger = _large_stars(stars)
        discard(stars)
        stars = _small_stars(larger)
        discard(larger)
        seen, now = now, _print(stars)
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
