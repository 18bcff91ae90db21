"""Row predicates and the reads a dashboard makes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import keep_first


def realtime_rows(passages: DataFrame) -> DataFrame:
    """Estimated (live) passages that announce a wait.

    Apply it after de-duplication: the row kept for a key decides whether the
    key counts.
    """
    return passages.where((F.col("type") == "E") & F.col("delaipassage").isNotNull())


def short_waits(df: DataFrame, max_wait: float = 15, wait: str = "attente_min") -> DataFrame:
    """Rows waiting at most ``max_wait`` minutes; unknown waits do not pass."""
    return df.where(F.col(wait) <= F.lit(max_wait))


def serving_filter(
    stats: DataFrame,
    lines: Sequence[str] | None = None,
    since: str | Column | None = None,
    columns: Sequence[str] = ("window_ts", "ligne", "avg_delay_min"),
) -> DataFrame:
    """Selected lines, strictly after ``since``, reduced to ``columns``."""
    if lines is not None:
        stats = stats.where(F.col("ligne").isin(*lines))
    if since is not None:
        since = F.lit(since).cast("timestamp") if isinstance(since, str) else since
        stats = stats.where(F.col("window_ts") > since)
    return stats.select(*columns)


def latest_windows(stats: DataFrame) -> DataFrame:
    """The newest window row of each (line, direction).

    Rows of one window that differ by route are ranked by passages, then by
    route code, so the choice does not depend on file order.
    """
    newest = [F.desc("window_ts"), F.desc("total_passages"), F.asc("route_code"), F.asc("pmr")]
    return keep_first(stats, ["ligne", "direction"], newest)
