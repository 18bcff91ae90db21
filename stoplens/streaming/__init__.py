from .changes import changes_stream
from .changes_table import write_changes
from .dedup import dedup_stream
from .sinks import (
    append_table,
    cassandra_table,
    console,
    finish,
    replace_table,
    run_to_end,
    start,
    upsert_table,
)
from .windows import live_window_stats

__all__ = [
    "append_table",
    "cassandra_table",
    "changes_stream",
    "console",
    "dedup_stream",
    "finish",
    "live_window_stats",
    "replace_table",
    "run_to_end",
    "start",
    "upsert_table",
    "write_changes",
]
