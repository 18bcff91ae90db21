"""Window statistics on a stream of passages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import delay_minutes
from ..operators.routes import match_routes
from .dedup import dedup_stream

GROUPS = ("ligne", "direction", "route_code", "pmr")


def live_window_stats(
    passages: DataFrame,
    routes: DataFrame,
    size: str = "10 minutes",
    delay: str = "10 minutes",
    dedup_keys: Sequence[str] | None = None,
    **join_options: int,
) -> DataFrame:
    """Same measures as the batch ``window_stats``, for a stream.

    Start it in complete mode for the whole table at every trigger (state is
    never dropped and late rows still count), in update mode for changed
    windows only, or in append mode for closed windows only. In the last two,
    rows behind the watermark are dropped and state stays bounded.

    Grouping is by the whole window: append mode needs the watermarked column
    among the groups, and the window's start alone does not carry it.

    Every observation counts unless ``dedup_keys`` is given, which needs append
    mode: Spark chains stateful operators in that mode only.
    """
    # Read once, so that the size measured is the size broadcast at every trigger.
    routes = routes.cache()
    counted = ["heurepassage", "ligne", "direction", "type", "delaipassage"]
    if dedup_keys:
        needed = passages.select(*dict.fromkeys([*dedup_keys, *counted]))
        marked = dedup_stream(needed, dedup_keys, delay=delay)
    else:
        marked = passages.withWatermark("heurepassage", delay)
    timed = marked.select(
        "heurepassage", "ligne", "direction", "type", delay_minutes("delaipassage").alias("_wait")
    )
    return (
        match_routes(timed, routes, **join_options)
        .groupBy(F.window("heurepassage", size).alias("_window"), *GROUPS)
        .agg(
            F.count("*").alias("total_passages"),
            F.avg("_wait").alias("avg_delay_min"),
            F.count(F.when(F.col("type") == "E", 1)).alias("realtime_count"),
        )
        .select(
            F.col("_window").getField("start").alias("window_ts"),
            *GROUPS,
            "total_passages",
            "avg_delay_min",
            "realtime_count",
        )
    )
