"""Changes of an announced wait, per passage, in arrival order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_dir

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 100_000
MAX_SLICES = 100_000


def changes(
    df: DataFrame,
    key: str = "id",
    value: str = "delaipassage",
    order: Sequence[str] = ("gid",),
    carry: Sequence[str] = ("ligne", "direction", "heurepassage"),
    hot_rows: int = HOT_ROWS,
    before: DataFrame | None = None,
) -> DataFrame:
    """``NEW`` for the first row of a key, ``UPDATE`` where its value differs
    from the row before; rows that repeat the value give nothing.

    NULL keys form one key and a NULL value equals a NULL value. Rows of equal
    ``order`` are taken by value. ``before`` (key and value, a row per key) holds
    the values that keys had before all of ``df``.

    A key of ``hot_rows`` rows or more is too much for one task to sort. The
    rows of such keys are range-partitioned on key and order, so that each
    partition is a run of consecutive rows, and every run is compared on its
    own after the last row before it has been put in front. The runs are kept
    in a table, since both steps must see the same cuts.
    """
    shown = list(dict.fromkeys([*order, *carry]))
    rows = df.select(*dict.fromkeys([key, value, *shown]))
    order = list(dict.fromkeys([*order, value]))
    hot, hot_total = _hot_keys(rows, key, hot_rows)
    if before is not None:
        before = before.select(key, value, F.lit(True).alias("_lead"))
    if hot is None:
        every = rows.withColumn("_slice", F.lit(0))
        if before is not None:
            every = every.withColumn("_lead", F.lit(False))
            every = every.unionByName(before.withColumn("_slice", F.lit(0)), allowMissingColumns=True)
        return _compare(every, key, value, order, shown)

    hot = F.broadcast(hot)
    is_hot = F.col(key).eqNullSafe(F.col("_hot_key"))
    cold = rows.join(hot, is_hot, "left_anti").withColumn("_slice", F.lit(0))
    slices = max(2, min(MAX_SLICES, -(-hot_total // hot_rows)))
    runs = _runs(rows.join(hot, is_hot, "left_semi"), [key, *order], slices)
    every = cold.unionByName(runs).withColumn("_lead", F.lit(False))
    every = every.unionByName(_leads(runs, key, order), allowMissingColumns=True)
    if before is not None:
        first = runs.groupBy(F.col(key).alias("_hot_key")).agg(F.min("_slice").alias("_slice"))
        place = F.col(key).eqNullSafe(F.col("_hot_key"))
        ahead = before.join(F.broadcast(first), place, "left").drop("_hot_key")
        every = every.unionByName(ahead.fillna(0, subset=["_slice"]), allowMissingColumns=True)
    return _compare(every, key, value, order, shown)


def _hot_keys(df: DataFrame, key: str, hot_rows: int) -> tuple[DataFrame | None, int]:
    """The hot keys, or None, and how many rows they have together.

    A hot key also holds at least 1/MAX_HOT_KEYS of all rows. So there are at
    most MAX_HOT_KEYS of them, whatever the size of the input, which bounds
    what is collected here and broadcast by the caller.
    """
    total = df.count()
    if total < hot_rows:
        return None, 0
    limit = max(hot_rows, -(-total // MAX_HOT_KEYS))
    found = (
        df.groupBy(F.col(key).alias("_hot_key"))
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") >= limit)
        .collect()
    )
    if not found:
        return None, 0
    kind = df.schema[key].dataType.simpleString()
    keys = df.sparkSession.createDataFrame([(row["_hot_key"],) for row in found], f"_hot_key {kind}")
    return keys, sum(row["_rows"] for row in found)


def _runs(df: DataFrame, order: Sequence[str], slices: int) -> DataFrame:
    """The rows with ``_slice``, the number of the range partition they fell in."""
    path = work_dir(df.sparkSession, "runs")
    ranged = df.repartitionByRange(slices, *order)
    ranged.withColumn("_slice", F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _leads(runs: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """For every run of a key but its first, the last row before it, in order and value."""
    last = F.max(F.struct(*order))
    return (
        runs.groupBy(key, "_slice")
        .agg(last.alias("_last"))
        .withColumn("_last", F.lag("_last").over(Window.partitionBy(key).orderBy("_slice")))
        .where("_last is not null")
        .select(key, "_slice", "_last.*", F.lit(True).alias("_lead"))
    )


def _compare(
    df: DataFrame, key: str, value: str, order: Sequence[str], shown: Sequence[str]
) -> DataFrame:
    """Rows unlike the one before them in their slice; leads only go before."""
    ahead = [F.desc("_lead")] if "_lead" in df.columns else []
    seen = Window.partitionBy(key, "_slice").orderBy(*ahead, *order)
    compared = df.withColumns(
        {
            "_old": F.lag(value).over(seen),
            "_first": F.lag(F.lit(True)).over(seen).isNull(),
        }
    )
    if "_lead" in df.columns:
        compared = compared.where(~F.col("_lead"))
    return compared.where(
        F.col("_first") | ~F.col("_old").eqNullSafe(F.col(value))
    ).select(
        F.when(F.col("_first"), F.lit("NEW")).otherwise(F.lit("UPDATE")).alias("event"),
        key,
        *shown,
        F.col("_old").alias("old_value"),
        F.col(value).alias("new_value"),
    )
