"""Writing keyed serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.contracts import conform, split_rejects
from ..schemas import ServingTable
from ..sources.serving import read_serving


def write_serving(
    df: DataFrame,
    path: str,
    table: ServingTable,
    write_id: int,
    rejects_path: str | None = None,
) -> None:
    """Upsert: rows replace those of equal keys from lower write ids.

    Each write adds one ``write_id=`` folder and touches no other, so it costs
    what the new rows cost, and repeating a write changes nothing. Readers
    pick the newest row per key (``sources.read_serving``). Rows are stored in
    the table's clustering order, cut by range, so one busy key may span
    several files. Rows without a required key go to ``rejects_path``; if it
    is not given, their presence is an error. The rows, statistics and so few
    beside what they were computed from, are kept while the steps read them.
    """
    if not isinstance(write_id, int):
        raise TypeError(f"write_id must be a number, not {write_id!r}")
    order = [F.desc(name) if newest else F.asc(name) for name, newest in table.clustering]
    kept = df.persist()
    try:
        good, rejects = split_rejects(kept, table)
        if rejects_path:
            rejects.write.mode("overwrite").parquet(f"{rejects_path}/write_id={write_id}")
        elif not rejects.isEmpty():
            raise ValueError(f"{table.name}: rows without a required key and no rejects_path")
        (
            conform(good, table)
            .repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .write.mode("overwrite")
            .parquet(f"{path}/write_id={write_id}")
        )
    finally:
        kept.unpersist()


def compact_serving(
    spark: SparkSession, path: str, new_path: str, table: ServingTable, write_id: int
) -> None:
    """Write the current rows of a table as the first folder of a new one.

    ``write_id`` is one the writers have passed; later upserts go to the new path.
    """
    write_serving(read_serving(spark, path, table), new_path, table, write_id)


def for_cassandra(good: DataFrame, table: ServingTable) -> DataFrame:
    """``good`` as rows that Cassandra can hold: key columns that may be NULL here are empty texts there."""
    optional = [name for name in table.keys if name not in table.required]
    return conform(good, table).fillna("", subset=optional) if optional else conform(good, table)


def write_cassandra(
    df: DataFrame, table: ServingTable, keyspace: str, truncate: bool = False
) -> DataFrame:
    """Upsert into a Cassandra table, or empty it first; returns the rows without a required key.

    Needs the Cassandra connector on the classpath.
    """
    good, rejects = split_rejects(df, table)
    writer = for_cassandra(good, table).write.format("org.apache.spark.sql.cassandra")
    writer = writer.options(table=table.name, keyspace=keyspace)
    if truncate:
        writer = writer.option("confirm.truncate", "true")
    writer.mode("overwrite" if truncate else "append").save()
    return rejects
