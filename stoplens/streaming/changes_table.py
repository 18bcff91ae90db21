"""Changes of an announced wait on a stream, each micro-batch compared by the batch operator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.changes import HOT_ROWS, changes
from ..sinks.rejects import write_batch
from ..sinks.writers import checked_folder
from .last_values import COMPACT_EVERY, LastValues


def write_changes(
    df: DataFrame,
    path: str,
    state_path: str,
    checkpoint: str,
    key: str = "id",
    value: str = "delaipassage",
    order: Sequence[str] = ("kafka_ts",),
    carry: Sequence[str] = ("ligne", "direction", "heurepassage"),
    hot_rows: int = HOT_ROWS,
    compact_every: int = COMPACT_EVERY,
) -> DataStreamWriter:
    """Writer of ``operators.changes`` over a stream, to a folder of this checkpoint below ``path``.

    Within a micro-batch rows count in ``order`` (without NULLs), equal ones by value; across
    micro-batches the source's order counts. A micro-batch's rows are compared with
    each other and with the last values of their keys, all in the JVM: a window per key that
    sorts and spills, and keys of ``hot_rows`` rows or more cut into runs. The values are in a
    table at ``state_path`` (``LastValues``), of which a micro-batch reads the newest base and
    the deltas after it and adds one delta, as large as its own keys. A repeated micro-batch
    replaces its events and its delta. A stream on a new checkpoint goes on from what the
    table holds when it first comes; one stream at a time may use a table.
    """
    fields = {f.name: f for f in df.schema.fields}
    spark = df.sparkSession
    folder = checked_folder(spark, path, checkpoint)
    state = LastValues(spark, state_path, fields[key], fields[value], compact_every)
    first = state.first_number(checkpoint)
    wanted = list(dict.fromkeys([key, value, *order, *carry]))

    def compare(batch: DataFrame, batch_id: int) -> None:
        number = first + batch_id
        rows = batch.select(*wanted).persist()
        try:
            met = rows.select(F.col(key).alias("_met")).distinct()
            known = state.before(number).join(met, F.col(key).eqNullSafe(F.col("_met")), "left_semi")
            events = changes(rows, key, value, order, carry, hot_rows, before=known)
            write_batch(events, folder, batch_id)
            last = F.max(F.struct(*order, value)).alias("last")
            state.put(rows.groupBy(key).agg(last).select(key, F.col(f"last.{value}").alias(value)), number)
        finally:
            rows.unpersist()

    return df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(compare)
