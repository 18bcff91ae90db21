from .feed import (
    decode,
    decode_records,
    explode_snapshot,
    good_records,
    read_snapshots,
    rejected_records,
    snapshot_records,
    stream_snapshots,
    typed_passages,
)
from .lake import read_lake
from .routes import read_routes
from .serving import read_serving
from .streams import stream_files, stream_kafka
from .written import read_written

__all__ = [
    "decode",
    "decode_records",
    "explode_snapshot",
    "good_records",
    "read_lake",
    "read_routes",
    "read_serving",
    "read_snapshots",
    "read_written",
    "rejected_records",
    "snapshot_records",
    "stream_files",
    "stream_kafka",
    "stream_snapshots",
    "typed_passages",
]
