"""Reading what several writers have added to one path.

Each writer has a folder of its own below the path, ``writer=<name>``. A stream's
folder is read through the log of what it committed, so files of failed attempts
don't show, and one writer's log hides nothing of another's.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

WRITER = "writer="
LOG = "_spark_metadata"
# Spark's conditions for a folder without a file, and for a stream's log without one.
NO_COLUMNS = ("UNABLE_TO_INFER_SCHEMA", "_LEGACY_ERROR_TEMP_1134")
# Name of the column that tells the micro-batches of a writer's folder apart.
BATCH = "_batch"


def _files(spark: SparkSession, path: str):
    """Hadoop's path of ``path`` and the file system it is in."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, files = _files(spark, path)
    return files.exists(hadoop)


def make_folder(spark: SparkSession, folder: str) -> None:
    hadoop, files = _files(spark, folder)
    files.mkdirs(hadoop)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of a table that its owner has replaced."""
    hadoop, files = _files(spark, folder)
    files.delete(hadoop, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, in order."""
    hadoop, files = _files(spark, pattern)
    return sorted(x.getPath().toString() for x in files.globStatus(hadoop) or [])


def writers(spark: SparkSession, path: str) -> list[str]:
    """The folders of the writers below ``path``."""
    return matching(spark, f"{path.rstrip('/')}/{WRITER}*")


def has_log(spark: SparkSession, folder: str) -> bool:
    return exists(spark, f"{folder}/{LOG}")


def without_batches(df: DataFrame) -> DataFrame:
    """Rows without the number of the micro-batch that wrote them, which is a folder's name only."""
    return df.drop(BATCH)


def _read_if_any(spark: SparkSession, folder: str) -> DataFrame | None:
    """Rows of a folder; none where no committed file says what columns there are, as of a stream that has only started."""
    try:
        return spark.read.parquet(folder)
    except AnalysisException as fault:
        if fault.getCondition() not in NO_COLUMNS:
            raise
        return None


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_written(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """All that was written to ``path``, by whichever writer; rows of older forms lack newer columns.

    With a ``schema``, writers that have written nothing yet give no rows; without it they
    are left out, as no file says what their columns would be.
    """
    folders = writers(spark, path)
    if schema is not None:
        found = [spark.read.schema(schema).parquet(x) for x in folders]
    else:
        found = [df for x in folders if (df := _read_if_any(spark, x)) is not None]
    if not found:
        raise FileNotFoundError(f"nothing was written to {path}")
    return without_batches(union(found))
