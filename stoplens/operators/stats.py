"""Grouped statistics of waits: per line, and per line and time window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import WAIT_PARSERS, delay_minutes
from .dedup import keep_first
from .filters import short_waits
from .routes import match_routes

OBSERVATION = ("id", "last_update_fme")


def _first_observations(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per observation; the remaining columns settle ties of ``order``."""
    return keep_first(df, keys, list(dict.fromkeys([*order, *df.columns])))


def stats_by(df: DataFrame, groups: Sequence[str], wait: str = "attente_min") -> DataFrame:
    """Mean, extremes, sample deviation and row count of ``wait`` per group."""
    measures = {
        "attente_moyenne_min": F.round(F.avg(wait), 2),
        "attente_max_min": F.max(wait),
        "attente_min_min": F.min(wait),
        "ecart_type_attente": F.round(F.stddev_samp(wait), 2),
        "total_enregistrements": F.count("*"),
    }
    return df.groupBy(*groups).agg(*[measure.alias(name) for name, measure in measures.items()])


def fill_missing(stats: DataFrame, value: float = 0.0) -> DataFrame:
    """A group of one row has no deviation; show ``value`` for it."""
    return stats.fillna(value, subset=["ecart_type_attente"])


def line_stats(
    passages: DataFrame,
    max_wait: float = 15,
    parser: str = "first_int",
    keys: Sequence[str] = OBSERVATION,
    order: Sequence[str] = ("gid",),
) -> DataFrame:
    """Waits of live passages per line and direction.

    Observations are de-duplicated on ``keys`` (the first under ``order``
    stays), then live rows with a known wait of at most ``max_wait`` minutes
    are summarised. ``parser`` picks the reading of the wait text: the default
    takes ``"1h05"`` as 1 minute and skips the labels, ``"delay_text"`` reads
    both in full.

    The wait is read before the de-duplication, as NULL for rows that are not
    live, so one number is shuffled instead of two texts. Whether a key counts
    is still decided by the row that was kept.
    """
    live_wait = F.when(F.col("type") == "E", WAIT_PARSERS[parser]("delaipassage"))
    needed = dict.fromkeys([*keys, *order, "ligne", "direction"])
    slim = passages.select(*needed, live_wait.alias("attente_min"))
    observed = _first_observations(slim, keys, order)
    return fill_missing(stats_by(short_waits(observed, max_wait), ["ligne", "direction"]))


def conditional_count(passages: DataFrame, groups: Sequence[str] = ("ligne", "direction")) -> DataFrame:
    """All rows and live rows per group."""
    return passages.groupBy(*groups).agg(
        F.count("*").alias("total_passages"),
        F.count(F.when(F.col("type") == "E", 1)).alias("realtime_count"),
    )


def window_stats(
    passages: DataFrame,
    routes: DataFrame,
    size: str = "10 minutes",
    dedup_keys: Sequence[str] | None = None,
    order: Sequence[str] = ("gid",),
    **join_options: int,
) -> DataFrame:
    """Passages, mean wait and live passages per window, line, direction and route.

    ``avg_delay_min`` averages the announced wait, not lateness. Every
    observation counts unless ``dedup_keys`` is given.

    Route matches depend on line and direction only, so rows are summed up per
    (window, line, direction) first and matched afterwards. The one shuffle
    then carries sums, and a hot line is already reduced when it takes place;
    the second grouping reuses its partitioning.
    """
    if dedup_keys:
        counted = ["heurepassage", "ligne", "direction", "delaipassage", "type"]
        slim = passages.select(*dict.fromkeys([*dedup_keys, *order, *counted]))
        passages = _first_observations(slim, dedup_keys, order)
    timed = passages.select(
        F.window("heurepassage", size).getField("start").alias("window_ts"),
        "ligne",
        "direction",
        "type",
        delay_minutes("delaipassage").alias("_wait"),
    )
    summed = timed.groupBy("window_ts", "ligne", "direction").agg(
        F.count("*").alias("_rows"),
        F.sum("_wait").alias("_wait_sum"),
        F.count("_wait").alias("_waits"),
        F.count(F.when(F.col("type") == "E", 1)).alias("_live"),
    )
    return (
        match_routes(summed, routes, **join_options)
        .groupBy("window_ts", "ligne", "direction", "route_code", "pmr")
        .agg(
            F.sum("_rows").alias("total_passages"),
            F.try_divide(F.sum("_wait_sum"), F.sum("_waits")).alias("avg_delay_min"),
            F.sum("_live").alias("realtime_count"),
        )
    )


def collapse_routes(stats: DataFrame) -> DataFrame:
    """One row per (window, line, direction): the route with most passages."""
    return keep_first(
        stats,
        ["window_ts", "ligne", "direction"],
        [F.desc("total_passages"), F.asc("route_code"), F.asc("pmr")],
    )
