"""The archive: Parquet under year=/month=/day=/hour= folders, at the root or of each writer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import archive_schema
from .written import has_log, matching, union, writers


def _months(spark: SparkSession, folder: str, year: int | None, month: int | None) -> list[str]:
    """The folders of a year and month below ``folder``; their numbers may have leading zeros."""
    years = matching(spark, f"{folder}/year=*")
    if year is not None:
        years = [x for x in years if int(x.rsplit("=", 1)[1]) == year]
    if month is None:
        return years
    months = [x for y in years for x in matching(spark, f"{y}/month=*")]
    return [x for x in months if int(x.rsplit("=", 1)[1]) == month]


def _read_folder(spark: SparkSession, folder: str, schema: T.StructType, year: int | None, month: int | None) -> DataFrame:
    """A batch writer's months are read by their paths, so no others are listed; a stream's log lists its files."""
    reader = spark.read.schema(schema)
    if has_log(spark, folder):
        lake = reader.parquet(folder)
    elif paths := _months(spark, folder, year, month):
        lake = reader.option("basePath", folder).parquet(*paths)
    else:
        return spark.createDataFrame([], schema)
    for name, value in {"year": year, "month": month}.items():
        if value is not None:
            lake = lake.where(F.col(name) == value)
    return lake.select(*schema.fieldNames())


def read_lake(
    spark: SparkSession,
    path: str,
    year: int | None = None,
    month: int | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Archived rows of a year and month, by every writer; folders of other months are not read.

    Files of the hour folders at the root, as other archivers write them, and those in
    writers' folders are read together, in the archive's declared columns and the text
    columns ``extra``; a file without one of them gives NULL. A stream that has written
    nothing yet has no rows.
    """
    root = path.rstrip("/")
    folders = writers(spark, root)
    if has_log(spark, root) or matching(spark, f"{root}/year=*"):
        folders = [root, *folders]
    if not folders:
        raise FileNotFoundError(f"no archive at {path}")
    schema = archive_schema(extra)
    return union([_read_folder(spark, x, schema, year, month) for x in folders])
