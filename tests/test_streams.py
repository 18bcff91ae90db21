import random

import pytest
from pyspark.sql import functions as F
from test_operators import brute_changes

from stoplens.operators import changes, keep_first, window_stats
from stoplens.plans import changes_job, live_stats_job
from stoplens.schemas import WINDOW_STATS
from stoplens.sources import read_serving, read_written, stream_files
from stoplens.sources.written import matching
from stoplens.streaming import (
    append_table,
    changes_stream,
    console,
    dedup_stream,
    live_window_stats,
    replace_table,
    run_to_end,
    upsert_table,
    write_changes,
)
from stoplens.streaming.last_values import LastValues
from workload.fixtures import EVENTS_SCHEMA, as_passages, passages, routes
from workload.queries import as_messages

FEED = "gid bigint, id string, ligne string, direction string, delaipassage string, type string, heurepassage timestamp, last_update_fme string"


def feed_file(spark, path, times, start=0):
    """One file of passages of one line at the given times of 2026-03-23."""
    items = [
        (start + at, f"p{start + at}", "93", "Perrache", "5 min", "E", f"2026-03-23 {time}:00", time)
        for at, time in enumerate(times)
    ]
    df = spark.createDataFrame(items, FEED.replace("timestamp", "string")).withColumn(
        "heurepassage", F.col("heurepassage").cast("timestamp")
    )
    df.coalesce(1).write.mode("append").parquet(path)


STAGED = [["09:01", "09:05"], ["09:45"], ["09:46"], ["09:02", "09:47"], ["10:30"]]


def staged(spark, tmp_path, batches):
    import time

    for at, times in enumerate(batches):
        feed_file(spark, f"{tmp_path}/in", times, 100 * at)
        time.sleep(1.1)  # the source takes files by modification time, in seconds
    schema = spark.createDataFrame([], FEED).schema
    return stream_files(spark, f"{tmp_path}/in", schema, files_per_batch=1)


def counts(df):
    found = df.select(F.date_format("window_ts", "HH:mm").alias("w"), "total_passages").collect()
    return {r["w"]: r["total_passages"] for r in found}


def test_late_rows_in_each_mode(spark, tmp_path):
    stats = live_window_stats(staged(spark, tmp_path, STAGED), routes(spark))
    run_to_end(replace_table(stats, f"{tmp_path}/complete", f"{tmp_path}/c1"))
    assert counts(spark.read.parquet(f"{tmp_path}/complete")) == {"09:00": 3, "09:40": 3, "10:30": 1}
    query = run_to_end(append_table(stats, f"{tmp_path}/append", f"{tmp_path}/c2"))
    assert counts(read_written(spark, f"{tmp_path}/append")) == {"09:00": 2, "09:40": 3}
    dropped = [step["stateOperators"][0]["numRowsDroppedByWatermark"] for step in query.recentProgress]
    assert sum(dropped) == 1
    run_to_end(upsert_table(stats, f"{tmp_path}/update", f"{tmp_path}/c3", WINDOW_STATS))
    table = read_serving(spark, f"{tmp_path}/update", WINDOW_STATS)
    assert counts(table) == {"09:00": 2, "09:40": 3, "10:30": 1}


def test_complete_mode_equals_batch_in_any_arrival_order(spark, sf_dir, tmp_path):
    feed = passages(spark, sf_dir)
    feed.orderBy(F.xxhash64("gid")).repartition(5, F.xxhash64("gid")).write.parquet(f"{tmp_path}/in")
    stream = stream_files(spark, f"{tmp_path}/in", feed.schema, files_per_batch=1)
    run_to_end(replace_table(live_window_stats(stream, routes(spark)), f"{tmp_path}/t", f"{tmp_path}/c"))
    batch = window_stats(feed, routes(spark))
    live = spark.read.parquet(f"{tmp_path}/t").select(*batch.columns)
    assert live.exceptAll(batch).isEmpty() and batch.exceptAll(live).isEmpty()


def test_late_row_counts_while_the_watermark_lags(spark, tmp_path):
    without = [times for times in STAGED if times != ["09:46"]]
    stats = live_window_stats(staged(spark, tmp_path, without), routes(spark))
    run_to_end(append_table(stats, f"{tmp_path}/append", f"{tmp_path}/c"))
    assert counts(read_written(spark, f"{tmp_path}/append"))["09:00"] == 3


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    schema = spark.createDataFrame([], FEED).schema

    def run():
        stream = stream_files(spark, f"{tmp_path}/in", schema)
        stats = live_window_stats(stream, routes(spark))
        run_to_end(replace_table(stats, f"{tmp_path}/table", f"{tmp_path}/checkpoint"))
        return counts(spark.read.parquet(f"{tmp_path}/table"))

    feed_file(spark, f"{tmp_path}/in", ["09:01", "09:05"])
    assert run() == {"09:00": 2}
    feed_file(spark, f"{tmp_path}/in", ["09:06", "09:11"], 100)
    assert run() == {"09:00": 3, "09:10": 1}
    assert run() == {"09:00": 3, "09:10": 1}


def test_dedup_on_a_stream(spark, tmp_path):
    feed_file(spark, f"{tmp_path}/in", ["09:01", "09:02"])
    feed_file(spark, f"{tmp_path}/in", ["09:01", "09:02"])
    schema = spark.createDataFrame([], FEED).schema
    stream = stream_files(spark, f"{tmp_path}/in", schema)
    run_to_end(append_table(dedup_stream(stream), f"{tmp_path}/out", f"{tmp_path}/c"))
    found = read_written(spark, f"{tmp_path}/out")
    assert found.count() == 2
    assert keep_first(found, ["id", "last_update_fme"], ["gid"]).count() == 2


def test_repeats_are_dropped_before_the_shuffle():
    import pyarrow as pa

    from stoplens.streaming.dedup import _newest_per_key

    batch = pa.RecordBatch.from_pylist(
        [{"id": key, "at": at, "n": n} for n, (key, at) in enumerate([("a", 1), (None, 5), ("a", 3), (None, 4), ("b", None)])]
    )
    (found,) = _newest_per_key(["id"], "at")(iter([batch]))
    assert sorted(row["n"] for row in found.to_pylist()) == [1, 2, 4]


def test_windows_after_dedup(spark, tmp_path):
    for _ in range(2):
        feed_file(spark, f"{tmp_path}/in", ["09:01", "09:02", "10:30"])
    schema = spark.createDataFrame([], FEED).schema
    stream = stream_files(spark, f"{tmp_path}/in", schema)
    stats = live_window_stats(stream, routes(spark), dedup_keys=["id", "last_update_fme"])
    run_to_end(append_table(stats, f"{tmp_path}/out", f"{tmp_path}/c"))
    assert counts(read_written(spark, f"{tmp_path}/out")) == {"09:00": 2}


def test_closed_windows_on_the_console(spark, tmp_path):
    feed_file(spark, f"{tmp_path}/in", ["09:01", "10:30"])
    schema = spark.createDataFrame([], FEED).schema
    stats = live_window_stats(stream_files(spark, f"{tmp_path}/in", schema), routes(spark))
    query = console(stats).trigger(availableNow=True).start()
    query.awaitTermination()
    assert "Console" in query.lastProgress["sink"]["description"]


def test_job_rejects_what_spark_cannot_run(spark, tmp_path):
    with pytest.raises(ValueError):
        live_stats_job(None, None, "", "", "update", dedup_keys=["id"])


@pytest.mark.parametrize("slice_width", [1, 7, 10_000])
@pytest.mark.parametrize("batches", [1, 3])
def test_change_stream_equals_brute_force(spark, tmp_path, slice_width, batches):
    import time

    rng = random.Random(batches * 100 + slice_width)
    items = [
        (at // 2, rng.choice([None, "a", "b"]), rng.choice([None, "None", "1 min", "2 min"]))
        for at in range(120)
    ]
    size = len(items) // batches
    for at in range(batches):
        part = items[at * size : (at + 1) * size]
        rng.shuffle(part)
        df = spark.createDataFrame(part, "gid bigint, id string, delaipassage string")
        df.repartition(1).write.mode("append").parquet(f"{tmp_path}/in")
        if at + 1 < batches:
            time.sleep(1.1)
    schema = spark.createDataFrame([], "gid bigint, id string, delaipassage string").schema
    stream = stream_files(spark, f"{tmp_path}/in", schema, files_per_batch=1)
    found = changes_stream(stream, carry=(), slice_width=slice_width)
    run_to_end(append_table(found, f"{tmp_path}/out", f"{tmp_path}/c"))
    rows = read_written(spark, f"{tmp_path}/out").select("event", "id", "gid", "old_value", "new_value")
    assert sorted((tuple(r) for r in rows.collect()), key=repr) == brute_changes(items)


@pytest.mark.parametrize("options", [{}, {"slice_width": 3600.0}])
def test_change_job_orders_by_arrival_time(spark, sf_dir, tmp_path, options):
    feed = passages(spark, sf_dir)
    messages = as_messages(as_passages(stream_files(spark, f"{sf_dir}/events.parquet*", EVENTS_SCHEMA)))
    run_to_end(changes_job(messages, f"{tmp_path}/out", f"{tmp_path}/c", **options))
    found = read_written(spark, f"{tmp_path}/out").withColumnRenamed("kafka_ts", "at")
    carry = ("ligne", "direction")
    expected = changes(feed.withColumn("at", F.col("heurepassage")), order=("at",), carry=carry)
    columns = ["event", "id", "at", *carry, "old_value", "new_value"]
    assert found.select(*columns).exceptAll(expected.select(*columns)).isEmpty()
    assert expected.select(*columns).exceptAll(found.select(*columns)).isEmpty()


CHANGE_ROWS = "gid bigint, id string, delaipassage string"


def change_files(spark, tmp_path, items, batches):
    """A stream of ``items`` dealt over files, a micro-batch each."""
    import time

    size = len(items) // batches
    for at in range(batches):
        part = spark.createDataFrame(items[at * size : (at + 1) * size], CHANGE_ROWS)
        part.orderBy(F.rand(at)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(1.1)
    return stream_files(spark, f"{tmp_path}/in", spark.createDataFrame([], CHANGE_ROWS).schema, files_per_batch=1)


def random_changes(seed, n=160, keys=(None, "hot", "hot", "hot", "a", "b")):
    rng = random.Random(seed)
    return [(at // 2, rng.choice(keys), rng.choice([None, "None", "1 min", "2 min"])) for at in range(n)]


def events_at(spark, path):
    rows = read_written(spark, path).select("event", "id", "gid", "old_value", "new_value")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


@pytest.mark.parametrize(("hot_rows", "batches", "compact_every"), [(1_000_000, 1, 50), (10, 4, 2), (1_000_000, 4, 1)])
def test_changes_by_table_equal_brute_force(spark, tmp_path, hot_rows, batches, compact_every):
    items = random_changes(hot_rows + batches)
    stream = change_files(spark, tmp_path, items, batches)
    options = {"order": ["gid"], "carry": (), "hot_rows": hot_rows, "compact_every": compact_every}
    run_to_end(write_changes(stream, f"{tmp_path}/out", f"{tmp_path}/state", f"{tmp_path}/c", **options))
    assert events_at(spark, f"{tmp_path}/out") == brute_changes(items)
    if batches == 4:
        # What a repeat of the last micro-batch may read is kept, nothing else.
        folders = sorted(x.rsplit("/", 1)[1] for x in matching(spark, f"{tmp_path}/state/*=*") if "first" not in x)
        assert folders == ({2: ["base=1", "base=3", "delta=2", "delta=3"], 1: ["base=2", "base=3", "delta=3"]}[compact_every])


def test_known_ids_stay_known_on_a_new_checkpoint(spark, tmp_path, monkeypatch):
    """As after the shape of a stream was raised."""
    from stoplens.plans import jobs

    def messages(path, *waits):
        texts = [(f'{{"id":"p{k}","gid":{k},"delaipassage":"{w}"}}', k) for k, w in enumerate(waits)]
        rows = spark.createDataFrame(texts, "value string, at bigint")
        rows.selectExpr("CAST(value AS BINARY) AS value", "timestamp_seconds(at) AS timestamp").write.parquet(path)
        return stream_files(spark, path, "value binary, timestamp timestamp")

    run_to_end(changes_job(messages(f"{tmp_path}/in1", "1 min", "2 min"), f"{tmp_path}/out", f"{tmp_path}/c"))
    monkeypatch.setattr(jobs, "SHAPE", jobs.SHAPE + 1)
    run_to_end(changes_job(messages(f"{tmp_path}/in2", "1 min", "3 min", "9 min"), f"{tmp_path}/out", f"{tmp_path}/c"))
    found = read_written(spark, f"{tmp_path}/out").select("event", "id", "old_value", "new_value")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [("NEW", "p0", None, "1 min"), ("NEW", "p1", None, "2 min"), ("UPDATE", "p1", "2 min", "3 min"), ("NEW", "p2", None, "9 min")], key=repr
    )


def test_repeated_changes_replace_themselves(spark, tmp_path):
    items = random_changes(3, n=80)
    stream = change_files(spark, tmp_path, items, 2)
    options = {"order": ["gid"], "carry": (), "compact_every": 1}
    writer = lambda: write_changes(stream, f"{tmp_path}/out", f"{tmp_path}/state", f"{tmp_path}/c", **options)
    run_to_end(writer())
    for name in ("1", ".1.crc"):  # as after a failure between the write and the commit
        (tmp_path / "c" / "commits" / name).unlink(missing_ok=True)
    run_to_end(writer())
    assert events_at(spark, f"{tmp_path}/out") == brute_changes(items)


def test_last_values_before_a_number(spark, tmp_path):
    schema = spark.createDataFrame([], "id string, wait string").schema
    table = LastValues(spark, f"{tmp_path}/state", *schema.fields, compact_every=3)
    assert table.before(0).count() == 0
    for n, rows in enumerate([[("a", "1"), (None, "x")], [("a", None)], [("b", "2")], [(None, "y")]]):
        table.put(spark.createDataFrame(rows, schema), n)
    values = lambda n: dict(map(tuple, table.before(n).collect()))
    assert values(4) == {"a": None, None: "y", "b": "2"} and values(3) == {"a": None, None: "x", "b": "2"}
    (tmp_path / "state" / "delta=3" / "_SUCCESS").unlink()  # a write that did not end
    assert values(4) == values(3)


def test_changes_by_table_run_in_the_jvm(spark, plan):
    df = spark.createDataFrame(random_changes(1), CHANGE_ROWS)
    before = spark.createDataFrame([("a", "1 min")], "id string, delaipassage string")
    assert "Python" not in plan(changes(df, carry=(), before=before)) and "Pandas" not in plan(changes(df, carry=(), hot_rows=10, before=before))
