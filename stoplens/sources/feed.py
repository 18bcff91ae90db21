"""Reading the feed: snapshot documents, JSON messages and archived text rows.

A passage's JSON text goes with its decoded columns where it is published or archived,
so fields the schema does not declare are kept; texts that cannot be read are told
apart, so a job can put them aside instead of losing them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import FEED_SCHEMA, UPDATE_STAMPS

# Texts that stand for a missing value in archives written by
# tools without NULLs.
MISSING_TEXTS = ("None", "nan", "NaT")

# Why a text was put aside.
NOT_JSON = "not a JSON object"
NO_PASSAGE = "values hold no object here"

CORRUPT = "_corrupt"


def _one_stamp(df: DataFrame) -> DataFrame:
    """The update stamp under one name, whichever name the feed used."""
    name, other = UPDATE_STAMPS
    if other not in df.columns:
        return df
    stamp = F.coalesce(name, other) if name in df.columns else F.col(other)
    return df.withColumn(name, stamp).drop(other)


def _parsed(text: Column, schema: T.StructType) -> Column:
    """``text`` as ``schema``, with its own text under CORRUPT if any of it could not be read."""
    fields = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(text, fields, {"columnNameOfCorruptRecord": CORRUPT})


def is_object(text: Column) -> Column:
    """Whether ``text`` is a JSON object, whatever its fields hold."""
    lone = T.StructType([T.StructField("gid", T.StringType())])
    return text.isNotNull() & (F.length(F.trim(text)) > 0) & _parsed(text, lone)[CORRUPT].isNull()


def read_snapshots(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Texts of snapshot documents (document), one per file, or one per line of a file."""
    return spark.read.text(path, wholetext=not one_per_line).withColumnRenamed("value", "document")


def stream_snapshots(
    spark: SparkSession, path: str, one_per_line: bool = False, files_per_batch: int = 1000
) -> DataFrame:
    """New snapshot documents as they are put below ``path``."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path, wholetext=not one_per_line).withColumnRenamed("value", "document")


def snapshot_records(snapshots: DataFrame) -> DataFrame:
    """Documents -> record, reason; a row for each element of their ``values``, in one pass.

    record is the element's JSON text as it stands in the document, reason NULL. A document
    that is no object, or whose ``values`` is no array, is one row with its whole text, and
    an element that is no object one with its own, each with a reason. A document without
    values, or with none, gives no row, and so does a blank one.
    """
    values = T.StructType([T.StructField("values", T.ArrayType(T.StringType()))])
    text = F.col("document")
    broken = F.array(F.struct(text.alias("record"), F.lit(NOT_JSON).alias("reason")))

    def element(record: Column) -> Column:
        no_object = F.when(~F.coalesce(is_object(record), F.lit(False)), F.lit(NO_PASSAGE))
        return F.struct(record.alias("record"), no_object.alias("reason"))

    read = snapshots.where(F.length(F.trim(text)) > 0).withColumn("read", _parsed(text, values))
    rows = F.when(F.col(f"read.{CORRUPT}").isNotNull(), broken).otherwise(F.transform("read.values", element))
    return read.select(F.explode(rows).alias("row")).select("row.*")


def good_records(records: DataFrame) -> DataFrame:
    """The rows without a reason to be put aside."""
    return records.where(F.col("reason").isNull()).drop("reason")


def rejected_records(records: DataFrame) -> DataFrame:
    """The others, with their reason."""
    return records.where(F.col("reason").isNotNull())


def explode_snapshot(snapshots: DataFrame) -> DataFrame:
    """One row per passage, decoded; a document without values gives none."""
    return decode(good_records(snapshot_records(snapshots)), "record", arrival=None)


def decode(
    messages: DataFrame,
    value: str = "value",
    arrival: str | None = "timestamp",
    schema: T.StructType = FEED_SCHEMA,
) -> DataFrame:
    """Passages out of JSON messages, with the broker time as ``kafka_ts``.

    Works on batch and streaming messages. A text that is not JSON gives a row
    of NULLs, a field of the wrong type gives NULL, other fields are ignored.
    """
    columns = [F.from_json(F.col(value).cast("string"), schema).alias("passage")]
    names = ["passage.*"]
    if arrival:
        columns.append(F.col(arrival).alias("kafka_ts"))
        names.append("kafka_ts")
    return _one_stamp(messages.select(*columns).select(*names))


def decode_records(
    messages: DataFrame,
    value: str = "value",
    arrival: str = "timestamp",
    schema: T.StructType = FEED_SCHEMA,
) -> DataFrame:
    """``decode`` with each message's whole text as ``record`` and a ``reason`` if it is no JSON object.

    A message without a value has no text either. A field of the wrong type is NULL among the
    columns, which is no reason: its text is in the record. Only messages of which some
    field could not be read are parsed a second time, to tell these two apart.
    """
    text = F.col(value).cast("string")
    read = messages.select(text.alias("record"), F.col(arrival).alias("kafka_ts"), _parsed(text, schema).alias("passage"))
    doubtful = F.col("record").isNull() | F.col(f"passage.{CORRUPT}").isNotNull() | (F.length(F.trim("record")) == 0)
    broken = F.when(doubtful, ~F.coalesce(is_object(F.col("record")), F.lit(False))).otherwise(False)
    reason = F.when(broken, F.lit(NOT_JSON)).alias("reason")
    return _one_stamp(read.select("passage.*", "kafka_ts", "record", reason).drop(CORRUPT))


def typed_passages(archived: DataFrame) -> DataFrame:
    """Archived text rows in the feed's types; missing-value texts become NULL."""
    archived = _one_stamp(archived)
    kinds = {f.name: f.dataType for f in FEED_SCHEMA.fields}

    def typed(name: str):
        if name not in kinds:
            return F.col(name)
        text = F.when(~F.col(name).isin(*MISSING_TEXTS), F.col(name))
        return text.try_cast(kinds[name]).alias(name)

    return archived.select(*[typed(name) for name in archived.columns])
