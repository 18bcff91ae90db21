"""Reading keyed serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import keep_first
from ..schemas import ServingTable


def read_serving(spark: SparkSession, path: str, table: ServingTable) -> DataFrame:
    """The newest row of every key.

    Filters on key columns reach the scan, as they do not depend on which
    write is newest.
    """
    writes = spark.read.schema(table.stored).parquet(path)
    return keep_first(writes, table.keys, [F.desc("write_id")]).drop("write_id")
