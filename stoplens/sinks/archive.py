"""Archiving passages as text rows under year=/month=/day=/hour= folders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from ..functions import arrival_parts, string_columns
from ..schemas import ARCHIVE_PARTS
from .rejects import split_stream, write_batch
from .writers import batch_folder, checked_folder, stream_folder

# Rows per file. Small files are a cost at every later read; pass 10,000 for
# files of the size the feed's original archiver wrote.
ROWS_PER_FILE = 2_000_000


def _archived(passages: DataFrame, arrival: str, legacy_nulls: bool) -> DataFrame:
    parts = [part.alias(name) for name, part in arrival_parts(arrival).items()]
    return passages.select(*string_columns(passages.columns, legacy_nulls), *parts)


def archive(
    passages: DataFrame,
    path: str,
    checkpoint: str,
    arrival: str = "kafka_ts",
    max_records: int = ROWS_PER_FILE,
    legacy_nulls: bool = False,
) -> DataStreamWriter:
    """Writer that appends a stream to the archive, each row once.

    Files are committed with the stream's progress, so a restart neither loses
    nor repeats rows, and the last incomplete file is written as well. A new
    checkpoint writes to a new folder beside those of other writers.
    """
    return (
        _archived(passages, arrival, legacy_nulls)
        .writeStream.format("parquet")
        .partitionBy(*ARCHIVE_PARTS)
        .option("path", stream_folder(passages.sparkSession, path, checkpoint))
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", max_records)
    )


def backfill_archive(
    passages: DataFrame,
    path: str,
    arrival: str = "kafka_ts",
    max_records: int = ROWS_PER_FILE,
    legacy_nulls: bool = False,
) -> None:
    """Append a batch of passages to the archive, in a folder beside those of streams.

    The rebalance hint brings an hour's rows together before the write, and
    lets AQE split an hour that is too big for one task.
    """
    (
        _archived(passages, arrival, legacy_nulls)
        .hint("rebalance", *ARCHIVE_PARTS)
        .write.mode("append")
        .partitionBy(*ARCHIVE_PARTS)
        .option("maxRecordsPerFile", max_records)
        .parquet(batch_folder(path))
    )


def archive_records(
    records: DataFrame,
    path: str,
    checkpoint: str,
    rejects_path: str,
    arrival: str = "kafka_ts",
    max_records: int = ROWS_PER_FILE,
    legacy_nulls: bool = False,
) -> DataStreamWriter:
    """Writer of a stream of decoded messages (``sources.decode_records``): each text to one output, once.

    Messages that are JSON objects go to the archive, their columns and their whole text
    (record), the others to ``rejects_path``. A micro-batch is read once. Within an hour its
    files are in a folder of its number, which it replaces when it is repeated, so a
    restart neither loses nor repeats rows; readers need no log and list the months asked for.
    """
    folder = checked_folder(records.sparkSession, path, checkpoint)

    def write(good: DataFrame, batch_id: int) -> None:
        rows = _archived(good, arrival, legacy_nulls)
        write_batch(rows, folder, batch_id, ARCHIVE_PARTS, maxRecordsPerFile=max_records)

    return split_stream(records, write, rejects_path, checkpoint)
