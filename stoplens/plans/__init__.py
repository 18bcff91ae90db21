from .jobs import (
    archive_job,
    changes_job,
    follow_job,
    line_stats_job,
    live_stats,
    live_stats_job,
    publish_job,
    serving_job,
    store_line_stats,
)

__all__ = [
    "archive_job",
    "changes_job",
    "line_stats_job",
    "live_stats",
    "live_stats_job",
    "publish_job",
    "serving_job",
    "store_line_stats",
]
