"""Dropping repeated observations on a stream."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# Send the code below to the workers itself, not its import path, so that the
# package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def dedup_stream(
    passages: DataFrame,
    keys: Sequence[str] = ("id", "last_update_fme"),
    event_time: str = "heurepassage",
    delay: str = "10 minutes",
) -> DataFrame:
    """One row per key among rows at most ``delay`` apart in event time.

    State is kept for ``delay`` only: a repeat that comes after its first row
    has expired passes again. Repeats that lie close together in the input are
    dropped before the shuffle already, so that a key with a large share of
    the rows does not send them all to one task. All columns of ``passages``
    cross to Python for this; select the needed ones before.
    """
    thinned = passages.mapInArrow(_newest_per_key(list(keys), event_time), passages.schema)
    return thinned.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def _newest_per_key(keys: list[str], event_time: str) -> Callable:
    """One row per key of every batch of rows: the newest.

    Older ones are late whenever it is, and the newest row of all stays, so
    neither the watermark nor the set of keys that pass it changes.
    """

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks = pc.sort_indices(batch, [(event_time, "descending")], null_placement="at_end")
            order = pa.array(np.arange(len(batch)))
            ranked = pa.table([*(batch.column(k).take(ranks) for k in keys), order], [*keys, "_at"])
            first = ranked.group_by(keys).aggregate([("_at", "min")])["_at_min"]
            yield batch.take(ranks.take(first.combine_chunks()))

    return thin
