"""Declared schemas of the feed, the routes file and the serving tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


TEXT = T.StringType()

# The field names of the feed and of the routes file, and the
# column names of the tables the results are stored in.

# The feed names its update stamp in two ways; decoding accepts both.
FEED_SCHEMA = _struct(
    coursetheorique=TEXT,
    delaipassage=TEXT,
    direction=TEXT,
    gid=T.LongType(),
    heurepassage=T.TimestampType(),
    id=TEXT,
    idtarretdestination=T.IntegerType(),
    last_update_fme=TEXT,
    last_updated_fme=TEXT,
    ligne=TEXT,
    type=TEXT,
)

UPDATE_STAMPS = ("last_update_fme", "last_updated_fme")


def feed_fields(*names: str) -> T.StructType:
    """The feed's schema reduced to some fields, so that only those are parsed."""
    wanted = set(names)
    if wanted & set(UPDATE_STAMPS):
        wanted.update(UPDATE_STAMPS)
    return T.StructType([field for field in FEED_SCHEMA.fields if field.name in wanted])


# An archived row is text, with the whole message as ``record``; its folders say when it came.
ARCHIVE_PARTS = ("year", "month", "day", "hour")


def archive_schema(extra: Sequence[str] = ()) -> T.StructType:
    """The columns of the archive, and the text columns ``extra``."""
    texts = dict.fromkeys([*FEED_SCHEMA.fieldNames(), "kafka_ts", "record", *extra], TEXT)
    return _struct(**texts, **dict.fromkeys(ARCHIVE_PARTS, T.IntegerType()))


# What could not be read, and why.
REJECTS_SCHEMA = _struct(record=TEXT, reason=TEXT, kafka_ts=T.TimestampType())

ROUTES_SCHEMA = _struct(
    ligne=TEXT,
    code_trace=TEXT,
    nom_trace=TEXT,
    sens=TEXT,
    nom_origine=TEXT,
    nom_destination=TEXT,
    pmr=TEXT,
)


@dataclass(frozen=True)
class ServingTable:
    """Shape of a keyed table.

    ``keys`` identify a row; those in ``required`` may not be NULL, the others
    take NULL as a value. ``clustering`` is the stored order: (column, newest
    first?) pairs.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    required: tuple[str, ...]
    clustering: tuple[tuple[str, bool], ...]

    @property
    def stored(self) -> T.StructType:
        """The columns of the files, with the number of the write they are from."""
        return T.StructType([*self.schema.fields, T.StructField("write_id", T.LongType())])


LINE_STATS = ServingTable(
    name="stats_historiques",
    schema=_struct(
        ligne=TEXT,
        direction=TEXT,
        attente_moyenne_min=T.FloatType(),
        attente_max_min=T.FloatType(),
        attente_min_min=T.FloatType(),
        ecart_type_attente=T.FloatType(),
        total_enregistrements=T.IntegerType(),
    ),
    keys=("ligne", "direction"),
    required=("ligne", "direction"),
    clustering=(("ligne", False), ("direction", False)),
)

# The route columns belong to the key: one (line, direction, window) can match
# several routes, and without them those rows would overwrite each other.
WINDOW_STATS = ServingTable(
    name="delay_stats",
    schema=_struct(
        window_ts=T.TimestampType(),
        ligne=TEXT,
        direction=TEXT,
        route_code=TEXT,
        pmr=TEXT,
        total_passages=T.LongType(),
        avg_delay_min=T.FloatType(),
        realtime_count=T.LongType(),
    ),
    keys=("ligne", "direction", "window_ts", "route_code", "pmr"),
    required=("ligne", "direction", "window_ts"),
    clustering=(("ligne", False), ("direction", False), ("window_ts", True)),
)
