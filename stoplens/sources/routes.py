"""The routes file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import ROUTES_SCHEMA


def read_routes(spark: SparkSession, path: str) -> DataFrame:
    """Routes from ``;``-separated text with a header; empty fields are NULL."""
    return spark.read.schema(ROUTES_SCHEMA).options(header=True, sep=";").csv(path)
