"""Changes of an announced wait on a stream, with the last value as keyed state."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import passage_json

# Send the code below to the workers itself, not its import path, so that the
# package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def changes_stream(
    df: DataFrame,
    key: str = "id",
    value: str = "delaipassage",
    order: str = "gid",
    carry: Sequence[str] = ("ligne", "direction", "heurepassage"),
    slice_width: float = 60,
) -> DataFrame:
    """Streaming form of ``operators.changes``, with the same output columns.

    Within a micro-batch a key's rows are taken by ``order``, a number or a
    time without NULLs, and equal ones by value; across micro-batches the
    source's order counts.

    A busy key is kept off a single task in two steps. The rows of a
    micro-batch are spread by key and slice of the order (``slice_width``
    numbers or seconds) and compared with the row before in their slice. Only
    the first row and the last value of each slice then meet the state, one
    value per key, kept for good. A slice should hold about as many rows as
    suit one task.

    The state needs the RocksDB store, which ``run_to_end`` and ``start`` set.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    carried = T.StructType([T.StructField(name, kinds[name]) for name in carry if name != order])
    event = T.StructType(
        [
            T.StructField("event", T.StringType()),
            T.StructField(key, kinds[key]),
            T.StructField(order, kinds[order]),
            T.StructField("_carried", T.StringType()),
            T.StructField("old_value", kinds[value]),
            T.StructField("new_value", kinds[value]),
        ]
    )
    slice_start = T.StructType(
        [*event.fields[1:4], *event.fields[5:], T.StructField("_last", kinds[value])]
    )

    # Columns that are only passed through cross to Python as one text.
    text = passage_json(*carried.names) if carried.names else F.lit("{}")
    position = F.floor(F.col(order).cast("double") / F.lit(slice_width))
    sliced = df.select(
        *dict.fromkeys([key, value, order]), text.alias("_carried"), position.alias("_slice")
    ).repartition(key, "_slice")

    inside = sliced.mapInPandas(_inside_slices(key, value, order), event)
    between = (
        sliced.mapInPandas(_slice_starts(key, value, order), slice_start)
        .groupBy(key)
        .transformWithState(_LastValue(key, order, kinds[value]), event, "append", "none")
    )
    return (
        inside.unionByName(between)
        .withColumn("_carried", F.from_json("_carried", carried))
        .select(
            "event",
            key,
            order,
            *[f"_carried.{name}" for name in carried.names],
            "old_value",
            "new_value",
        )
    )


def _in_order(
    chunks: Iterator[pd.DataFrame], key: str, value: str, order: str
) -> tuple[pd.DataFrame, np.ndarray, np.ndarray] | None:
    """The rows of a partition by key, slice, order and value, where a slice
    starts, and a code for each value (NULLs have one of their own)."""
    parts = [chunk for chunk in chunks if len(chunk)]
    if not parts:
        return None
    rows = pd.concat(parts, ignore_index=True)
    keys = pd.factorize(rows[key], use_na_sentinel=False)[0]
    codes = pd.factorize(rows[value], sort=True)[0]
    ranks = np.lexsort((codes, rows[order].to_numpy(), rows["_slice"].to_numpy(), keys))
    rows, keys, codes = rows.iloc[ranks], keys[ranks], codes[ranks]
    slices = rows["_slice"].to_numpy()
    first = np.ones(len(rows), dtype=bool)
    first[1:] = (keys[1:] != keys[:-1]) | (slices[1:] != slices[:-1])
    return rows, first, codes


def _inside_slices(key: str, value: str, order: str) -> Callable:
    """Rows unlike the one before them in the same slice."""

    def compare(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = _in_order(chunks, key, value, order)
        if found is None:
            return
        rows, first, codes = found
        at = np.flatnonzero(~first & (codes != np.roll(codes, 1)))
        picked = rows.iloc[at]
        yield pd.DataFrame(
            {
                "event": "UPDATE",
                key: picked[key],
                order: picked[order],
                "_carried": picked["_carried"],
                "old_value": rows[value].to_numpy()[at - 1],
                "new_value": picked[value],
            }
        )

    return compare


def _slice_starts(key: str, value: str, order: str) -> Callable:
    """The first row of each slice, with the last value of the slice."""

    def reduce(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = _in_order(chunks, key, value, order)
        if found is None:
            return
        rows, first, _ = found
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(rows)) - 1
        picked = rows.iloc[starts]
        yield pd.DataFrame(
            {
                key: picked[key],
                order: picked[order],
                "_carried": picked["_carried"],
                "new_value": picked[value],
                "_last": rows[value].to_numpy()[ends],
            }
        )

    return reduce


class _LastValue(StatefulProcessor):
    """Keeps the last value of a key and reports slices that start with another."""

    def __init__(self, key: str, order: str, kind: T.DataType):
        self.key, self.order, self.kind = key, order, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType([T.StructField("value", self.kind)])
        self.last = handle.getValueState("last", schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802
        state = self.last.get()
        seen, last = state is not None, state[0] if state is not None else None
        before = (seen, last)
        for row in sorted(rows, key=lambda row: row[self.order]):
            if not seen or row["new_value"] != last:
                yield Row(
                    event="UPDATE" if seen else "NEW",
                    **{name: row[name] for name in (self.key, self.order, "_carried")},
                    old_value=last,
                    new_value=row["new_value"],
                )
            seen, last = True, row["_last"]
        if before != (seen, last):
            self.last.update((last,))

    def close(self) -> None:
        pass
