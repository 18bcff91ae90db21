"""One query per operator or job, each a function of (spark, sf_dir).

Queries that write do so in a fresh folder below the session's checkpoint
directory and return what a reader of that output sees.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stoplens.functions import (
    arrival_parts,
    delay_minutes,
    first_int_minutes,
    json_field,
    passage_json,
    string_columns,
    stringify,
)
from stoplens.operators import (
    changes,
    collapse_routes,
    conditional_count,
    contract_violations,
    fill_missing,
    keep_first,
    latest_windows,
    line_stats,
    match_routes,
    realtime_rows,
    short_waits,
    split_rejects,
    stats_by,
    window_stats,
)
from stoplens.plans import (
    archive_job,
    changes_job,
    follow_job,
    line_stats_job,
    live_stats_job,
    publish_job,
    serving_job,
)
from stoplens.schemas import ARCHIVE_PARTS, LINE_STATS, WINDOW_STATS
from stoplens.session import work_dir
from stoplens.sinks import archive, backfill_archive, publish_frame, read_rejects, write_serving
from stoplens.sources import (
    decode,
    explode_snapshot,
    read_lake,
    read_routes,
    read_serving,
    read_snapshots,
    read_written,
    stream_files,
    typed_passages,
)
from stoplens.streaming import append_table, dedup_stream, live_window_stats, run_to_end

from .fixtures import EVENTS_SCHEMA, as_passages, named_passages, named_routes, part_routes, passages, routes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PASSAGE = ["gid", "id", "ligne", "direction", "delaipassage", "type", "heurepassage", "last_update_fme"]
OBSERVATION = ["id", "last_update_fme"]

# Middle of the events' month; splits it for the serving queries.
MID_MONTH = "2024-01-15 00:00:00"
SNAPSHOT_SIZE = 100


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


# --- sources and decoding ---------------------------------------------------


query("passages")(passages)


@query("routes_scan")
def routes_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "routes")
    part_routes(spark, sf_dir).write.options(header=True, sep=";").csv(path)
    return read_routes(spark, path)


# Fields the feed's schema does not declare.
UNDECLARED = {
    "quai": "concat('Q', CAST(gid % 5 AS STRING))",
    "infos": "named_struct('niveau', gid % 3, 'texte', ligne)",
}


def records(rows: DataFrame) -> DataFrame:
    """Passages with their JSON texts, undeclared fields among them."""
    return rows.selectExpr("*", *[f"{text} AS {name}" for name, text in UNDECLARED.items()]).withColumn("record", passage_json(*PASSAGE, *UNDECLARED))


# What documents hold beside or instead of their passages, by poll modulo 5: a text cut
# short, values that are no array, elements that are no passages, no values at all.
DOCUMENT = """CASE poll % 5 WHEN 1 THEN left(whole, length(whole) - 3)
  WHEN 2 THEN concat('{{"values":{{"poll":', CAST(poll AS {text}), '}}}}')
  WHEN 3 THEN concat(left(whole, length(whole) - 2), ',"text ', CAST(poll AS {text}), '",', CAST(poll AS {text}), ',null]}}')
  WHEN 4 THEN concat('{{"poll":', CAST(poll AS {text}), '}}') ELSE whole END"""


def write_snapshots(spark: SparkSession, sf_dir: str, broken: bool = False) -> str:
    """Snapshot documents of SNAPSHOT_SIZE passages each, one per line; some ``broken``."""
    path = work_dir(spark, "snapshots")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("gid", "record"))), lambda x: x["record"])
    documents = (
        records(passages(spark, sf_dir))
        .groupBy(F.floor(F.col("gid") / SNAPSHOT_SIZE).alias("poll"))
        .agg(F.concat(F.lit('{"values":['), F.array_join(texts, ","), F.lit("]}")).alias("whole"))
    )
    documents.select(F.expr(DOCUMENT.format(text="STRING")) if broken else "whole").write.text(path)
    return path


@query("snapshot_explode")
def snapshot_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_snapshots(spark, sf_dir)
    return explode_snapshot(read_snapshots(spark, path, one_per_line=True)).select(*PASSAGE)


@query("snapshot_publish")
def snapshot_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "publish")
    send = lambda frame: frame.write.parquet(f"{out}/messages")
    publish_job(spark, write_snapshots(spark, sf_dir), send, f"{out}/rejects", one_per_line=True)
    frame = spark.read.parquet(f"{out}/messages")
    return frame.select("key", json_field("value", "gid").cast("bigint").alias("gid"), "value")


@query("snapshot_publish_stream")
def snapshot_publish_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "publish-stream")
    send = lambda frame: frame.write.mode("append").parquet(f"{out}/messages")
    run_to_end(follow_job(spark, write_snapshots(spark, sf_dir), send, f"{out}/rejects", f"{out}/checkpoint", one_per_line=True))
    return decode(spark.read.parquet(f"{out}/messages"), arrival=None).select(*PASSAGE)


@query("corrupt_documents")
def corrupt_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was published and what was put aside of documents some of which are broken."""
    out = work_dir(spark, "corrupt")
    send = lambda frame: frame.write.parquet(f"{out}/messages")
    publish_job(spark, write_snapshots(spark, sf_dir, broken=True), send, f"{out}/rejects", one_per_line=True)
    sent = spark.read.parquet(f"{out}/messages").select(F.col("value").alias("record"), F.lit(None).cast("string").alias("reason"))
    return sent.unionByName(read_rejects(spark, f"{out}/rejects").drop("kafka_ts"))


@query("publish_keyed")
def publish_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = publish_frame(passages(spark, sf_dir))
    names = ["gid", "id", "ligne", "direction", "delaipassage", "type", "last_update_fme"]
    absent = json_field("value", "coursetheorique", "absent").alias("coursetheorique")
    fields = frame.select("key", absent, F.json_tuple("value", *names).alias(*names))
    return fields.withColumn("gid", F.col("gid").cast("bigint"))


def as_messages(rows: DataFrame) -> DataFrame:
    """Passages as the broker would deliver them: key, bytes, arrival time."""
    return rows.select(
        passage_json(*PASSAGE).cast("binary").alias("value"),
        F.col("heurepassage").alias("timestamp"),
    )


@query("decode_passages")
def decode_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(as_messages(passages(spark, sf_dir))).select(*PASSAGE, "kafka_ts")


@query("stringify_all")
def stringify_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stringify(passages(spark, sf_dir))


@query("stringify_legacy_nulls")
def stringify_legacy_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stringify(passages(spark, sf_dir).drop("heurepassage"), legacy_nulls=True)


@query("arrival_parts")
def arrival_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = arrival_parts("heurepassage")
    return passages(spark, sf_dir).select("gid", *[part.alias(name) for name, part in parts.items()])


# --- archive ----------------------------------------------------------------


def stream_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As a pattern the path may be one file or a folder of files.
    return as_passages(stream_files(spark, f"{sf_dir}/events.parquet*", EVENTS_SCHEMA))


ARCHIVED = [*PASSAGE, "year", "month", "day", "hour"]


@query("archive_roundtrip")
def archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "archive")
    stream = stream_passages(spark, sf_dir)
    run_to_end(archive(stream, f"{out}/lake", f"{out}/checkpoint", "heurepassage", max_records=10_000))
    return read_lake(spark, f"{out}/lake").select(*ARCHIVED)


def backfilled_lake(spark: SparkSession, sf_dir: str) -> str:
    lake = work_dir(spark, "lake")
    backfill_archive(passages(spark, sf_dir), lake, "heurepassage")
    return lake


@query("lake_month_scan")
def lake_month_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of two archived months; passages after MID_MONTH arrive a month late."""
    lake = work_dir(spark, "two-months")
    delay = F.make_ym_interval(F.lit(0), (F.col("heurepassage") >= MID_MONTH).cast("int"))
    late = passages(spark, sf_dir).withColumn("arrival", F.col("heurepassage") + delay)
    backfill_archive(late, lake, "arrival")
    return read_lake(spark, lake, year=2024, month=2).select(*ARCHIVED)


@query("lake_line_stats")
def lake_line_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_stats_job(spark, backfilled_lake(spark, sf_dir), year=2024, month=1)


@query("replayed_archive")
def replayed_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages decoded and archived as text with legacy NULLs, then typed and summarised."""
    out = work_dir(spark, "replay")
    messages = as_messages(stream_passages(spark, sf_dir))
    run_to_end(archive_job(messages, f"{out}/lake", f"{out}/checkpoint", legacy_nulls=True))
    return line_stats_job(spark, f"{out}/lake")


# Messages by gid modulo 50: cut short, an array, a number as text, any other.
MESSAGE = """CASE gid % 50 WHEN 0 THEN left(record, length(record) - 2) WHEN 1 THEN concat('[', record, ']')
  WHEN 2 THEN replace(record, '"gid":', '"gid":"no","n":') ELSE record END"""


@query("archived_records")
def archived_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts of archived messages and of those put aside, some of which are broken."""
    out = work_dir(spark, "archive-records")
    rows = records(stream_passages(spark, sf_dir))
    messages = rows.select(F.expr(MESSAGE).cast("binary").alias("value"), F.col("heurepassage").alias("timestamp"))
    run_to_end(archive_job(messages, f"{out}/lake", f"{out}/checkpoint"))
    kept = read_lake(spark, f"{out}/lake").select("record", F.lit(None).cast("string").alias("reason"), "gid", "ligne", "hour")
    aside = read_rejects(spark, f"{out}/lake-rejects")
    return kept.unionByName(aside.select("record", "reason", F.hour("kafka_ts").alias("hour")), allowMissingColumns=True)


@query("lake_root_layout")
def lake_root_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month of a lake with hour folders at its root, to which two writers have added."""
    out = work_dir(spark, "root-lake")
    rows = passages(spark, sf_dir)
    parts = [part.alias(name) for name, part in arrival_parts("heurepassage").items()]
    old = rows.where("gid % 3 = 0").select(*string_columns(PASSAGE, legacy_nulls=True), *parts)
    old.write.partitionBy(*ARCHIVE_PARTS).parquet(f"{out}/lake")
    backfill_archive(rows.where("gid % 3 = 1"), f"{out}/lake", "heurepassage")
    stream = stream_passages(spark, sf_dir).where("gid % 3 = 2")
    run_to_end(archive(stream, f"{out}/lake", f"{out}/checkpoint", "heurepassage"))
    return typed_passages(read_lake(spark, f"{out}/lake", 2024, 1)).select(*ARCHIVED)


# --- scalar functions, filters, de-duplication ------------------------------


@query("parse_first_int")
def parse_first_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = passages(spark, sf_dir)
    return rows.select("gid", "delaipassage", first_int_minutes("delaipassage").alias("attente_min"))


@query("parse_delay")
def parse_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = passages(spark, sf_dir)
    return rows.select("gid", "delaipassage", delay_minutes("delaipassage").alias("delai_minutes"))


@query("dedup_observations")
def dedup_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(passages(spark, sf_dir), OBSERVATION, ["gid"])


@query("dedup_stream")
def dedup_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream form: the stamp is an hour, so repeats are less than an hour apart."""
    out = work_dir(spark, "dedup")
    needed = stream_passages(spark, sf_dir).select(*OBSERVATION, "heurepassage")
    rows = dedup_stream(needed, OBSERVATION, delay="1 hour")
    run_to_end(append_table(rows.select(*OBSERVATION), f"{out}/rows", f"{out}/checkpoint"))
    return read_written(spark, f"{out}/rows")


@query("realtime_rows")
def live_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return realtime_rows(keep_first(passages(spark, sf_dir), OBSERVATION, ["gid"]))


@query("short_waits")
def short_wait_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = realtime_rows(passages(spark, sf_dir))
    wait = first_int_minutes("delaipassage").alias("attente_min")
    return short_waits(live.select("gid", "ligne", "direction", wait), 15)


# --- statistics -------------------------------------------------------------


@query("batch_line_stats")
def batch_line_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_stats(passages(spark, sf_dir))


@query("line_stats_delay_text")
def line_stats_delay_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_stats(passages(spark, sf_dir), parser="delay_text", max_wait=90)


@query("fill_missing")
def fill_missing_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = passages(spark, sf_dir).withColumn("attente_min", first_int_minutes("delaipassage"))
    return fill_missing(stats_by(rows, ["id"]))


@query("route_enrich")
def route_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_routes(passages(spark, sf_dir), routes(spark))


@query("route_enrich_shuffled")
def route_enrich_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join used when the routes are too big to broadcast."""
    return match_routes(passages(spark, sf_dir), routes(spark), max_broadcast_bytes=0, salts=4)


@query("route_enrich_indexed")
def route_enrich_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes that grow with the data, by the index of their names."""
    return match_routes(named_passages(spark, sf_dir), named_routes(spark, sf_dir), max_broadcast_bytes=0)


@query("conditional_count")
def live_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conditional_count(passages(spark, sf_dir))


@query("window_stats")
def batch_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_stats(passages(spark, sf_dir), routes(spark))


@query("window_stats_dedup")
def window_stats_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_stats(passages(spark, sf_dir), routes(spark), dedup_keys=OBSERVATION)


@query("window_stats_collapsed")
def window_stats_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse_routes(window_stats(passages(spark, sf_dir), routes(spark)))


# --- live statistics --------------------------------------------------------


def live_windows(spark: SparkSession, sf_dir: str, mode: str) -> str:
    out = work_dir(spark, f"windows-{mode}")
    messages = as_messages(stream_passages(spark, sf_dir))
    run_to_end(
        live_stats_job(
            messages,
            routes(spark),
            f"{out}/table",
            f"{out}/checkpoint",
            mode,
            rejects_path=f"{out}/rejects" if mode == "update" else None,
        )
    )
    return out


@query("window_stats_stream")
def window_stats_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(live_windows(spark, sf_dir, "complete") + "/table")


@query("window_stats_append")
def window_stats_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_written(spark, live_windows(spark, sf_dir, "append") + "/table")


@query("window_stats_update")
def window_stats_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_serving(spark, live_windows(spark, sf_dir, "update") + "/table", WINDOW_STATS)


# Scheduled passages (type T) reach the stream one stage after live ones of
# the same half of the month, and are late by then.
STAGES = 4
STAGE = "CAST(floor((day(heurepassage) - 1) / 15) AS INT) + CASE type WHEN 'T' THEN 1 ELSE 0 END"


@query("late_rows")
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows of a stream fed in stages, restarted for each on one checkpoint."""
    out = work_dir(spark, "late")
    staged = passages(spark, sf_dir).withColumn("stage", F.expr(STAGE))
    schema = staged.drop("stage").schema
    for stage in range(STAGES):
        rows = staged.where(F.col("stage") == stage).drop("stage")
        rows.write.mode("append").parquet(f"{out}/in")
        stream = stream_files(spark, f"{out}/in", schema)
        stats = live_window_stats(stream, routes(spark))
        run_to_end(append_table(stats, f"{out}/table", f"{out}/checkpoint"))
    return read_written(spark, f"{out}/table")


CHANGED = ["ligne", "direction", "heurepassage", "old_value", "new_value"]


# --- changes ----------------------------------------------------------------


@query("change_events")
def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(passages(spark, sf_dir))


@query("change_events_sliced")
def change_events_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids merged into a few hot ones (among them NULL), handled slice by slice."""
    rows = passages(spark, sf_dir).withColumn("id", F.col("ligne"))
    return changes(rows, hot_rows=1000)


@query("change_events_stream")
def change_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "changes")
    messages = as_messages(stream_passages(spark, sf_dir))
    run_to_end(changes_job(messages, f"{out}/events", f"{out}/checkpoint", order="gid"))
    return read_written(spark, f"{out}/events").select("event", "id", "gid", *CHANGED)


@query("change_events_staged")
def change_events_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job as it is by default over several micro-batches, restarted for each.

    The topic's order is by stage, then time, then value.
    """
    out = work_dir(spark, "changes-staged")
    staged = passages(spark, sf_dir).withColumn("stage", F.expr(STAGE))
    for stage in range(STAGES):
        as_messages(staged.where(F.col("stage") == stage)).write.mode("append").parquet(f"{out}/in")
        stream = stream_files(spark, f"{out}/in", "value binary, timestamp timestamp")
        run_to_end(changes_job(stream, f"{out}/events", f"{out}/checkpoint", compact_every=2))
    return read_written(spark, f"{out}/events").select("event", "id", "kafka_ts", *CHANGED)


# --- serving ----------------------------------------------------------------


@query("serving_upsert")
def serving_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the month, then of its second half without one line, whose
    rows of the first write stay."""
    path = work_dir(spark, "line-stats")
    rows = passages(spark, sf_dir)
    late = rows.where((F.col("heurepassage") >= MID_MONTH) & (F.col("ligne") != "T1"))
    for write_id, part in enumerate([rows, late]):
        write_serving(line_stats(part), f"{path}/table", LINE_STATS, write_id, f"{path}/rejects")
    return read_serving(spark, f"{path}/table", LINE_STATS)


@query("contract_violations")
def contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window statistics against a key without the route columns."""
    stats = window_stats(passages(spark, sf_dir), routes(spark))
    return contract_violations(stats, ["ligne", "direction", "window_ts"])


@query("serving_rejects")
def serving_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_rejects(window_stats(passages(spark, sf_dir), routes(spark)), WINDOW_STATS)[1]


def store_windows(spark: SparkSession, sf_dir: str) -> str:
    path = work_dir(spark, "serving")
    stats = window_stats(passages(spark, sf_dir), routes(spark))
    write_serving(stats, f"{path}/table", WINDOW_STATS, 0, f"{path}/rejects")
    return f"{path}/table"


@query("serving_scan")
def serving_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_serving(spark, store_windows(spark, sf_dir), WINDOW_STATS)


@query("serving_filter")
def serving_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving_job(spark, store_windows(spark, sf_dir), ["C7", "93"], MID_MONTH)


@query("serving_latest")
def serving_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_windows(read_serving(spark, store_windows(spark, sf_dir), WINDOW_STATS))
