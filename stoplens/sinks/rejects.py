"""Putting aside what cannot be read, beside the rows that can, in one pass."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..schemas import REJECTS_SCHEMA
from ..sources.feed import good_records, rejected_records
from ..sources.written import BATCH, exists, read_written
from .writers import batch_folder, own_folder


def write_batch(rows: DataFrame, folder: str, batch_id: int, parts: tuple[str, ...] = (), **options: object) -> None:
    """Rows as micro-batch ``batch_id`` of a stream's folder, below the folders of ``parts``; a repeat replaces them."""
    (
        rows.withColumn(BATCH, F.lit(batch_id))
        .write.mode("overwrite")
        .options(partitionOverwriteMode="dynamic", **options)
        .partitionBy(*parts, BATCH)
        .parquet(folder)
    )


def write_rejects(rejects: DataFrame, folder: str, batch_id: int) -> None:
    """Rows (record, reason, perhaps kafka_ts) as batch ``batch_id`` of ``folder``; a repeat replaces it."""
    columns = [
        (F.col(f.name) if f.name in rejects.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in REJECTS_SCHEMA.fields
    ]
    write_batch(rejects.select(*columns), folder, batch_id)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """All that writers have put aside at ``path``."""
    return read_written(spark, path, REJECTS_SCHEMA)


def split_once(records: DataFrame, write: Callable[[DataFrame], None], rejects_path: str) -> None:
    """Rows without a ``reason`` to ``write``, the others to ``rejects_path``; ``records`` are computed once.

    Each call adds to the rejects of earlier ones.
    """
    spark, folder = records.sparkSession, batch_folder(rejects_path)
    number = 0
    while exists(spark, f"{folder}/{BATCH}={number}"):
        number += 1
    kept = records.persist()
    try:
        write(good_records(kept))
        write_rejects(rejected_records(kept), folder, number)
    finally:
        kept.unpersist()


def split_stream(
    records: DataFrame, write: Callable[[DataFrame, int], None], rejects_path: str, checkpoint: str
) -> DataStreamWriter:
    """``split_once`` for each micro-batch of a stream; ``write`` gets its number as well.

    A micro-batch that is repeated after a failure replaces its own rejects; ``write`` must
    do likewise for its rows to count once.
    """
    folder = own_folder(rejects_path, checkpoint)

    def split(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            write(good_records(kept), batch_id)
            write_rejects(rejected_records(kept), folder, batch_id)
        finally:
            kept.unpersist()

    return records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(split)
