"""Streaming sources."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .written import make_folder, matching


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_batch: int | None = None,
    bytes_per_batch: int = 64 * 1024**3,
    latest_for: str | None = None,
) -> DataFrame:
    """New Parquet files below ``path``, oldest first.

    A micro-batch takes up to ``files_per_batch`` files if that is given, else
    up to ``bytes_per_batch``. Either limit also bounds what a stateful
    operator sees of one key at a time.

    A first start replays what is there. With ``latest_for``, the checkpoint of
    the stream, it takes only files modified since; the time is noted there, so
    a restart goes on with all files that have come meanwhile.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    if latest_for is None:
        return reader.parquet(path)
    since = F.timestamp_millis(F.lit(first_start(spark, latest_for)))
    # A condition on the file alone: files that do not meet it are not opened.
    return reader.parquet(path).where(F.col("_metadata.file_modification_time") >= since)


def first_start(spark: SparkSession, checkpoint: str) -> int:
    """When the stream with this checkpoint was first started, in milliseconds; now, if it is being so."""
    name = f"{checkpoint.rstrip('/')}/first-start"
    noted = matching(spark, f"{name}=*")
    if noted:
        return int(noted[0].rsplit("=", 1)[1])
    now = int(time.time() * 1000)
    make_folder(spark, f"{name}={now}")
    return now


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    rows_per_batch: int = 10_000_000,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Messages of a topic. Needs the Kafka connector on the classpath.

    ``starting`` matters on a first start only; a restart goes on from its
    checkpoint. Use ``"earliest"`` to replay.
    """
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": str(rows_per_batch),
        **(options or {}),
    }
    return spark.readStream.format("kafka").options(**settings).load()
