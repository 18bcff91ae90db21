"""Announced waits are free text; two readings of them are in use.

They differ on purpose. The batch statistics take the first number of the text
(``"1h05"`` is 1), the live statistics read hours and the two labels as well
(``"1h05"`` is 65). Results depend on which one is meant, so neither replaces
the other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts the feed uses instead of a number, and their minutes.
LABEL_MINUTES = {"Proche": 0.5, "A l'arret": 0.0}

# The number forms of the feed.
FIRST_NUMBER = r"(\d+)"
MINUTES_FORM = r"^\d+\s*min$"
HOURS_FORM = r"^\d+h\d+$"
HOURS_PART = r"^(\d+)h"
REST_PART = r"h(\d+)$"


def _number(text: Column, pattern: str) -> Column:
    # A missing group gives '', which a plain cast rejects under ANSI rules.
    return F.regexp_extract(text, pattern, 1).try_cast("float")


def first_int_minutes(text: Column | str) -> Column:
    """First whole number in the text as float minutes, NULL without a digit."""
    return _number(F.col(text) if isinstance(text, str) else text, FIRST_NUMBER)


def delay_minutes(text: Column | str) -> Column:
    """Minutes (double) of ``N min``, ``HhMM`` and the labels; NULL otherwise."""
    text = F.col(text) if isinstance(text, str) else text
    hours, rest = _number(text, HOURS_PART), _number(text, REST_PART)
    minutes = F.when(text.rlike(MINUTES_FORM), _number(text, FIRST_NUMBER).cast("double"))
    minutes = minutes.when(text.rlike(HOURS_FORM), (hours * 60 + rest).cast("double"))
    for label, value in LABEL_MINUTES.items():
        minutes = minutes.when(text == label, F.lit(value))
    return minutes


WAIT_PARSERS = {"first_int": first_int_minutes, "delay_text": delay_minutes}
