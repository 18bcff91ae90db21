"""The jobs a user runs, each a chain of the library's operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from ..operators import line_stats, serving_filter
from ..schemas import LINE_STATS, WINDOW_STATS, feed_fields
from ..sinks import archive_records, publish_stream, record_frame, split_once, write_serving
from ..sources import (
    decode,
    decode_records,
    read_lake,
    read_serving,
    read_snapshots,
    snapshot_records,
    stream_snapshots,
    typed_passages,
)
from ..streaming import (
    append_table,
    changes_stream,
    live_window_stats,
    replace_table,
    upsert_table,
    write_changes,
)

# Part of the checkpoint path. Raise it when a stream's grouping or state
# changes: the new shape then starts from a new checkpoint.
SHAPE = 1


# The fields live statistics and change events read.
COUNTED = ("heurepassage", "ligne", "direction", "type", "delaipassage")


def _checkpoint(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}-shape{SHAPE}"


def publish_job(
    spark: SparkSession,
    snapshots: str,
    send: Callable[[DataFrame], None],
    rejects_path: str,
    one_per_line: bool = False,
) -> None:
    """Passages of snapshot documents to ``send`` as key and value, each as its text stands.

    Documents and elements that are none go to ``rejects_path`` with the reason.
    """
    records = snapshot_records(read_snapshots(spark, snapshots, one_per_line))
    split_once(records, lambda good: send(record_frame(good)), rejects_path)


def follow_job(
    spark: SparkSession,
    snapshots: str,
    send: Callable[[DataFrame], None],
    rejects_path: str,
    checkpoint: str,
    one_per_line: bool = False,
) -> DataStreamWriter:
    """``publish_job`` for new documents as they come."""
    records = snapshot_records(stream_snapshots(spark, snapshots, one_per_line))
    return publish_stream(records, send, rejects_path, _checkpoint(checkpoint, "publish"))


def archive_job(
    messages: DataFrame, lake: str, checkpoint: str, rejects_path: str | None = None, **options: object
) -> DataStreamWriter:
    """Messages to the partitioned archive, with their whole texts.

    Those that are no JSON objects go to ``rejects_path``, by default ``<lake>-rejects``.
    """
    rejects_path = rejects_path or f"{lake.rstrip('/')}-rejects"
    return archive_records(decode_records(messages), lake, _checkpoint(checkpoint, "archive-records"), rejects_path, **options)


def line_stats_job(
    spark: SparkSession,
    lake: str,
    year: int | None = None,
    month: int | None = None,
    **options: object,
) -> DataFrame:
    """Line statistics of a month of the archive."""
    return line_stats(typed_passages(read_lake(spark, lake, year, month)), **options)


def store_line_stats(stats: DataFrame, path: str, write_id: int, rejects_path: str | None = None) -> None:
    """Upsert line statistics into their serving table; rows without a key go to ``<path>-rejects``."""
    write_serving(stats, path, LINE_STATS, write_id, rejects_path or f"{path.rstrip('/')}-rejects")


def live_stats(
    messages: DataFrame,
    routes: DataFrame,
    dedup_keys: Sequence[str] | None = None,
    **options: object,
) -> DataFrame:
    """Messages to streaming window statistics."""
    passages = decode(messages, schema=feed_fields(*COUNTED, *(dedup_keys or ())))
    return live_window_stats(passages, routes, dedup_keys=dedup_keys, **options)


def live_stats_job(
    messages: DataFrame,
    routes: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "update",
    rejects_path: str | None = None,
    **options: object,
) -> DataStreamWriter:
    """Messages to window statistics in a table at ``path``.

    ``update`` (upserts, bounded state), ``append`` (closed windows only) or
    ``complete`` (whole table at every trigger, unbounded state). The table of ``update``
    is keyed: rows without a line or direction go to ``rejects_path``, by default
    ``<path>-rejects``. The other two keep them.
    """
    if options.get("dedup_keys") and mode != "append":
        raise ValueError("dedup_keys needs append mode")
    stats = live_stats(messages, routes, **options)
    checkpoint = _checkpoint(checkpoint, f"windows-{mode}")
    if mode == "update":
        rejects_path = rejects_path or f"{path.rstrip('/')}-rejects"
        return upsert_table(
            stats, path, checkpoint, WINDOW_STATS, rejects_path, first_write_id=SHAPE * 10**12
        )
    if mode == "append":
        return append_table(stats, path, checkpoint)
    if mode == "complete":
        return replace_table(stats, path, checkpoint)
    raise ValueError(f"unknown mode {mode!r}")


def changes_job(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    order: str = "kafka_ts",
    state_path: str | None = None,
    slice_width: float | None = None,
    **options: object,
) -> DataStreamWriter:
    """Messages to change events of each passage id.

    The last values are in a table at ``state_path``, by default ``<path>-state``. They outlast
    the checkpoint: after a change of SHAPE, known ids still give UPDATE. With ``slice_width``
    they are in the stream's own state store instead (``changes_stream``), and don't.
    """
    rows = decode(messages, schema=feed_fields("id", "gid", *COUNTED))
    if slice_width is not None:
        events = changes_stream(rows, order=order, slice_width=slice_width, **options)
        return append_table(events, path, _checkpoint(checkpoint, "changes"))
    state_path = state_path or f"{path.rstrip('/')}-state"
    return write_changes(rows, path, state_path, _checkpoint(checkpoint, "changes"), order=[order], **options)


def serving_job(
    spark: SparkSession,
    path: str,
    lines: Sequence[str] | None = None,
    since: str | None = None,
) -> DataFrame:
    """Stored window statistics, optionally of some lines and after a time."""
    return serving_filter(read_serving(spark, path, WINDOW_STATS), lines, since)
