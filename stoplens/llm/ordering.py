"""Places of rows in a sorted table, per group, without a task that sees a whole group.

Rows are dealt by range of (group, order), sorted within partitions and written with
their partition and place there. One row per (partition, group) then carries what comes
before it in earlier partitions, so a group of any size spans as many tasks as it needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import staged

BEFORE = (Window.unboundedPreceding, -1)


def _sorted(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """``rows`` with part and place. Equal rows are told apart, so copies don't share one partition."""
    told = rows.withColumn("tie", F.monotonically_increasing_id())
    dealt = told.repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "tie").drop("tie")
    return staged(dealt.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), label)


def _beside(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of ``other``, unique by ``keys``; nulls are equal."""
    renamed = other.withColumnsRenamed({k: f"other_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"other_{k}")) for k in keys]
    return rows.join(renamed, same).drop(*[f"other_{k}" for k in keys])


def _ranked(groups: DataFrame, group: str) -> DataFrame:
    """``groups`` with group_index, their place by ``group`` (null first)."""
    rows = _sorted(groups, [group], "groups")
    parts = rows.groupBy("part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    # A row per partition: few, whatever the number of groups.
    offset = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*BEFORE)), F.lit(0))
    parts = parts.select("part", (offset - F.col("first")).alias("shift"))
    return rows.join(parts, "part").withColumn("group_index", F.col("place") + F.col("shift")).drop("part", "place", "shift")


def ordered(
    rows: DataFrame,
    group: str,
    order: list[str],
    amount: str | None = None,
    extend: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``rows`` sorted by ``group`` and ``order`` -> (rows, groups).

    groups has a row per value of ``group``: group, group_index (its place, null first),
    group_rows and, with ``amount`` (a column of whole numbers), group_sum; ``extend`` may
    add columns. rows get all these, index (place in the group, from 0) and, with
    ``amount``, before (its sum over the group's earlier rows). Rows that agree in all of
    group and order come in any order.
    """
    # Written once before the sort: sampling the ranges would work its columns out a second time.
    rows = _sorted(staged(rows, "unordered"), [group, *order], "ordered")
    total = F.sum(F.col(amount) if amount else F.lit(0)).alias("sum")
    pieces = staged(rows.groupBy("part", group).agg(F.count("*").alias("n"), F.min("place").alias("first"), total), "pieces")
    groups = pieces.groupBy(group).agg(F.sum("n").alias("group_rows"), F.sum("sum").alias("group_sum"))
    groups = _ranked(groups if amount else groups.drop("group_sum"), group)
    groups = staged(extend(groups) if extend else groups, "group-sizes")
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(*BEFORE)
    pieces = pieces.select(
        "part",
        group,
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("piece_before"),
    )
    if amount:
        # A piece is at most a partition, so this window is bounded as well.
        here = Window.partitionBy("part", group).orderBy("place").rowsBetween(*BEFORE)
        rows = rows.withColumn("in_piece", F.coalesce(F.sum(amount).over(here), F.lit(0)))
    # Groups meet the few pieces, not the rows, of which one group may have a third.
    found = _beside(rows, _beside(pieces, groups, [group]), ["part", group])
    found = found.withColumn("index", F.col("place") + F.col("shift"))
    if amount:
        found = found.withColumn("before", F.col("piece_before") + F.col("in_piece")).drop("in_piece")
    return found.drop("part", "place", "shift", "piece_before"), groups
