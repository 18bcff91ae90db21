"""Publishing passages as keyed JSON messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions import passage_json, publish_key
from .rejects import split_stream

# Delivery settings of the feed's publisher.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.compression.type": "snappy",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "100",
    "kafka.retries": "3",
}


def publish_frame(passages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key`` and ``value`` of each passage, plus the columns in ``keep``."""
    return passages.select(
        publish_key().alias("key"), passage_json(*passages.columns).alias("value"), *keep
    )


def record_frame(records: DataFrame) -> DataFrame:
    """``key`` and ``value`` of JSON texts (record), each published as it stands.

    Only the key's fields are read, as text, so a line or number of any JSON type counts.
    Other columns are kept.
    """
    fields = F.from_json("record", "ligne string, gid string").alias("_key")
    others = [c for c in records.columns if c != "record"]
    key = publish_key("_key.ligne", "_key.gid").alias("key")
    return records.select("record", *others, fields).select(key, F.col("record").alias("value"), *others)


def _settings(servers: str, topic: str, options: dict[str, str] | None) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        **PRODUCER_OPTIONS,
        **(options or {}),
    }


def write_kafka(
    frame: DataFrame, servers: str, topic: str, options: dict[str, str] | None = None
) -> None:
    """Send key and value to a topic. Needs the Kafka connector on the classpath."""
    settings = _settings(servers, topic, options)
    frame.select("key", "value").write.format("kafka").options(**settings).save()


def stream_to_kafka(
    frame: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    options: dict[str, str] | None = None,
) -> DataStreamWriter:
    """Streaming form of ``write_kafka``."""
    settings = _settings(servers, topic, options)
    return (
        frame.select("key", "value")
        .writeStream.format("kafka")
        .options(**settings)
        .option("checkpointLocation", checkpoint)
    )


def publish_stream(
    records: DataFrame,
    send: Callable[[DataFrame], None],
    rejects_path: str,
    checkpoint: str,
) -> DataStreamWriter:
    """``send`` gets key and value of each micro-batch's passages; what is none goes to ``rejects_path``.

    ``send`` may be ``write_kafka`` with its settings. After a failure a micro-batch is sent
    again, as with any Kafka sink.
    """

    def write(good: DataFrame, batch_id: int) -> None:
        send(record_frame(good))

    return split_stream(records, write, rejects_path, checkpoint)
