"""Column helpers for keys, JSON text, partition parts and string forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def json_field(text: Column | str, name: str, default: str | None = None) -> Column:
    """A field of a JSON text, or ``default`` when it is absent or null."""
    value = F.get_json_object(text, f"$.{name}")
    return value if default is None else F.coalesce(value, F.lit(default))


def publish_key(line: str = "ligne", row: str = "gid") -> Column:
    """Message key: the line, else the feed row number as text, else ``'0'``."""
    return F.coalesce(F.col(line), F.col(row).cast("string"), F.lit("0"))


def passage_json(*columns: str) -> Column:
    """JSON text of the columns; NULLs are written, not left out."""
    return F.to_json(
        F.struct(*columns), {"ignoreNullFields": "false", "timestampFormat": JSON_TIME}
    )


def arrival_parts(arrival: Column | str) -> dict[str, Column]:
    """Year, month, day and hour texts, zero-padded, of an arrival time."""
    formats = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return {name: F.date_format(arrival, form) for name, form in formats.items()}


def string_columns(names: Sequence[str], legacy_nulls: bool = False) -> list[Column]:
    """The columns as text. ``legacy_nulls`` writes NULL as the text ``None``."""
    texts = {name: F.col(name).cast("string") for name in names}
    if legacy_nulls:
        texts = {name: F.coalesce(text, F.lit("None")) for name, text in texts.items()}
    return [text.alias(name) for name, text in texts.items()]


def stringify(df: DataFrame, legacy_nulls: bool = False) -> DataFrame:
    """Every column of ``df`` as text."""
    return df.select(*string_columns(df.columns, legacy_nulls))
