from .changes import changes
from .contracts import conform, contract_violations, split_rejects
from .dedup import keep_first
from .filters import latest_windows, realtime_rows, serving_filter, short_waits
from .routes import match_routes
from .stats import (
    collapse_routes,
    conditional_count,
    fill_missing,
    line_stats,
    stats_by,
    window_stats,
)

__all__ = [
    "changes",
    "collapse_routes",
    "conditional_count",
    "conform",
    "contract_violations",
    "fill_missing",
    "keep_first",
    "latest_windows",
    "line_stats",
    "match_routes",
    "realtime_rows",
    "serving_filter",
    "short_waits",
    "split_rejects",
    "stats_by",
    "window_stats",
]
