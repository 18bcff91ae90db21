from .fields import (
    arrival_parts,
    json_field,
    passage_json,
    publish_key,
    string_columns,
    stringify,
)
from .waits import WAIT_PARSERS, delay_minutes, first_int_minutes

__all__ = [
    "WAIT_PARSERS",
    "arrival_parts",
    "delay_minutes",
    "first_int_minutes",
    "json_field",
    "passage_json",
    "publish_key",
    "string_columns",
    "stringify",
]
