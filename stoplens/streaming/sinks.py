"""Stream outputs: whole-table replacement, append and keyed upsert."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..schemas import ServingTable
from ..session import ROCKSDB, STATE_STORE
from ..sinks.serving import write_cassandra, write_serving
from ..sinks.writers import stream_folder


def replace_table(stats: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Complete mode: every trigger truncates the table and writes it anew.

    State and writes grow with the table; see ``upsert_table`` for long runs.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return (
        stats.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(replace)
    )


def append_table(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append mode: finished rows only, each written once.

    They are in a folder of this checkpoint below ``path``; ``read_written`` reads all.
    """
    return (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", stream_folder(rows.sparkSession, path, checkpoint))
        .option("checkpointLocation", checkpoint)
    )


def upsert_table(
    stats: DataFrame,
    path: str,
    checkpoint: str,
    table: ServingTable,
    rejects_path: str | None = None,
    first_write_id: int = 0,
) -> DataStreamWriter:
    """Update mode: every trigger upserts the rows it changed.

    A repeated micro-batch rewrites its own folder, so nothing counts twice. A
    stream on a new checkpoint numbers its batches from 0 again and needs a
    ``first_write_id`` above the ids already in the table.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        write_serving(batch, path, table, first_write_id + batch_id, rejects_path)

    return (
        stats.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(upsert)
    )


def cassandra_table(
    stats: DataFrame,
    checkpoint: str,
    table: ServingTable,
    keyspace: str,
    rejects_path: str,
    mode: str = "update",
    write: Callable[..., DataFrame] = write_cassandra,
) -> DataStreamWriter:
    """Update mode upserts changed rows, complete mode replaces the table.

    Rows without a required key go to ``rejects_path``, a folder for each micro-batch; with
    complete mode only the last one is the table's. ``write`` is what puts the rows.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            rejects = write(kept, table, keyspace, truncate=mode == "complete")
            rejects.write.mode("overwrite").parquet(f"{rejects_path.rstrip('/')}/write_id={batch_id}")
        finally:
            kept.unpersist()

    return (
        stats.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(upsert)
    )


def console(rows: DataFrame, num_rows: int = 20) -> DataStreamWriter:
    """Print finished rows, cells in full, up to ``num_rows`` of each micro-batch."""
    writer = rows.writeStream.outputMode("append").format("console")
    return writer.option("truncate", False).option("numRows", num_rows)


@contextmanager
def _state_on_disk() -> Iterator[None]:
    """RocksDB as the state store of streams started within."""
    conf = SparkSession.active().conf
    before = conf.get(STATE_STORE)
    conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        conf.set(STATE_STORE, before)


def start(writer: DataStreamWriter, every: str = "1 minute") -> StreamingQuery:
    """Run until stopped, one micro-batch per interval."""
    with _state_on_disk():
        return writer.trigger(processingTime=every).start()


def finish(query: StreamingQuery, seconds: float = 600) -> None:
    """Stop a stream between two micro-batches, or after ``seconds``; raises what it failed with.

    What is stopped within a micro-batch is done again at the next start.
    """
    until = time.monotonic() + seconds
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
        time.sleep(0.05)
    query.stop()
    if query.exception() is not None:
        raise query.exception()


def run_to_end(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there now, then stop; the next run goes on from there."""
    with _state_on_disk():
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
