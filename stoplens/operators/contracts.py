"""Checks and casts that rows pass before they reach a keyed table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ServingTable


def _null_key(required: Sequence[str]) -> Column:
    return reduce(or_, [F.col(name).isNull() for name in required])


def contract_violations(
    df: DataFrame, keys: Sequence[str], required: Sequence[str] | None = None
) -> DataFrame:
    """Keys that break a table's contract, with the rows involved.

    ``null_key`` when a required key column (default: any) is NULL,
    ``duplicate_key`` when several rows share the key; both can apply.
    """
    broken = F.array_compact(
        F.array(
            F.when(_null_key(required or keys), F.lit("null_key")),
            F.when(F.col("n_rows") > 1, F.lit("duplicate_key")),
        )
    )
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n_rows"))
        .select(F.explode(broken).alias("violation"), *keys, "n_rows")
    )


def split_rejects(df: DataFrame, table: ServingTable) -> tuple[DataFrame, DataFrame]:
    """Rows the table can hold, and rows with a NULL in a required key column."""
    null_key = _null_key(table.required)
    return df.where(~null_key), df.where(null_key)


def conform(df: DataFrame, table: ServingTable) -> DataFrame:
    """The table's columns in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in table.schema.fields])
