"""Reading the given tables and keeping intermediate results on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stoplens.session import ship_package, work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Spark's setting that removes shuffle files as soon as the query that wrote them has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back.

    Cuts the lineage: what follows reads files that survive lost executors,
    and nothing above is computed a second time. The shuffles behind it are
    read by nothing else, so their files go at once.
    """
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{label}")
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    found = spark.read.schema(df.schema).parquet(path)
    found._staged_at = path
    return found


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table._staged_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand Python ``rows`` rows at a time, for this session: texts are long, and two batches of
    the default 10,000 are a large part of an executor's memory. Workers get this package."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
