from .archive import archive, archive_records, backfill_archive
from .publish import publish_frame, publish_stream, record_frame, stream_to_kafka, write_kafka
from .rejects import read_rejects, split_once, split_stream
from .serving import compact_serving, write_cassandra, write_serving

__all__ = [
    "archive",
    "archive_records",
    "backfill_archive",
    "compact_serving",
    "publish_frame",
    "publish_stream",
    "read_rejects",
    "record_frame",
    "split_once",
    "split_stream",
    "stream_to_kafka",
    "write_cassandra",
    "write_kafka",
    "write_serving",
]
