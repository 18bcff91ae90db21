"""Whole records and rejects: snapshots, messages, archives in both layouts."""

import json

import pytest
from pyspark.sql import functions as F

from stoplens.operators import split_rejects
from stoplens.plans import archive_job, follow_job, publish_job
from stoplens.schemas import ARCHIVE_PARTS, LINE_STATS, WINDOW_STATS
from stoplens.sinks import archive, backfill_archive, read_rejects, record_frame, split_once
from stoplens.sinks.serving import for_cassandra
from stoplens.sources import (
    decode_records,
    explode_snapshot,
    read_lake,
    read_snapshots,
    read_written,
    snapshot_records,
    stream_files,
)
from stoplens.streaming import append_table, cassandra_table, finish, run_to_end, start

NOT_JSON, NO_PASSAGE = "not a JSON object", "values hold no object here"


def lines(path, *texts):
    path.mkdir(exist_ok=True)
    (path / f"part-{len(list(path.iterdir()))}.json").write_text("\n".join(texts) + "\n", encoding="utf-8")


def test_every_element_and_document_is_accounted_for(spark, tmp_path):
    lines(
        tmp_path / "in",
        '{"values":[{"ligne":"C7","gid":1,"quai":{"n":[1,2]}}, {"gid":"x"}, 5, null, "t", [1], {}]}',
        '{"values":[{"ligne":"C7"',
        '{"values":{"a":1}}',
        '{"values":null}', '{"values":[]}', '{"other":1}', "", "   ",
        "[1,2]", "12", '"text"', "no json", "null",
    )
    found = [tuple(r) for r in snapshot_records(read_snapshots(spark, str(tmp_path / "in"), one_per_line=True)).collect()]
    expected = [
        ('{"ligne":"C7","gid":1,"quai":{"n":[1,2]}}', None), ('{"gid":"x"}', None), ("{}", None),
        ("5", NO_PASSAGE), (None, NO_PASSAGE), ("t", NO_PASSAGE), ("[1]", NO_PASSAGE),
        *[(x, NOT_JSON) for x in ('{"values":[{"ligne":"C7"', '{"values":{"a":1}}', "[1,2]", "12", '"text"', "no json")],
    ]
    # JSON's null is no document, and none of its text is lost either.
    rest = [x for x in found if x != ("null", NOT_JSON)]
    assert sorted(rest, key=str) == sorted(expected, key=str)


def test_whole_file_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"values": [\n {"ligne": "C7", "extra": "é"}\n]}', encoding="utf-8")
    rows = snapshot_records(read_snapshots(spark, str(tmp_path))).collect()
    assert [json.loads(r["record"]) for r in rows] == [{"ligne": "C7", "extra": "é"}]
    assert explode_snapshot(read_snapshots(spark, str(tmp_path))).first()["ligne"] == "C7"


def test_keys_of_published_records(spark):
    texts = ['{"ligne":"C7","gid":1}', '{"gid":12,"n":{"a":[1]}}', '{"ligne":93}', '{"ligne":null,"gid":"7"}', "{}"]
    frame = record_frame(spark.createDataFrame([(t,) for t in texts], "record string")).collect()
    assert [tuple(r) for r in frame] == list(zip(["C7", "12", "93", "7", "0"], texts, strict=True))


def test_messages_tell_broken_texts_from_wrong_types(spark):
    texts = ['{"gid":1,"ligne":"C7","last_updated_fme":"u","more":1}', '{"gid":"no","ligne":"T1"}', "{", "[{}]", "", " ", None, "3", "{}"]
    messages = spark.createDataFrame([(t,) for t in texts], "value string").selectExpr(
        "CAST(value AS BINARY) AS value", "timestamp'2024-01-01 05:00:00' AS timestamp"
    )
    found = decode_records(messages)
    assert "_corrupt" not in found.columns
    got = {r["record"]: (r["gid"], r["ligne"], r["last_update_fme"], r["reason"]) for r in found.collect()}
    bad = (None, None, None, NOT_JSON)
    assert got == {
        texts[0]: (1, "C7", "u", None), texts[1]: (None, "T1", None, None), "{}": (None, None, None, None),
        **dict.fromkeys(["{", "[{}]", "", " ", None, "3"], bad),
    }


def test_batches_of_rejects_add_up(spark, tmp_path):
    records = spark.createDataFrame([("a", None), ("b", "why")], "record string, reason string")
    sent = []
    for _ in range(2):
        split_once(records, lambda good: sent.extend(good.collect()), f"{tmp_path}/r")
    split_once(records.where("reason is null"), lambda good: sent.extend(good.collect()), f"{tmp_path}/r")
    assert [tuple(r) for r in sent] == [("a",)] * 3
    assert [tuple(r) for r in read_rejects(spark, f"{tmp_path}/r").collect()] == [("b", "why", None)] * 2


def test_records_are_read_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    records = spark.range(10).select(counted(F.lit("x")).alias("record"), F.when(F.col("id") > 7, "w").alias("reason"))
    split_once(records, lambda good: good.write.parquet(f"{tmp_path}/good"), f"{tmp_path}/r")
    assert seen.value == 10 and spark.read.parquet(f"{tmp_path}/good").count() == 8


def test_followed_folder(spark, tmp_path):
    sent = []

    def run():
        send = lambda frame: sent.extend(frame.collect())
        run_to_end(follow_job(spark, f"{tmp_path}/in", send, f"{tmp_path}/rejects", f"{tmp_path}/c", one_per_line=True))

    lines(tmp_path / "in", '{"values":[{"ligne":"A"}]}', "broken")
    run()
    lines(tmp_path / "in", '{"values":[{"ligne":"B"},7]}')
    run()
    run()
    assert [r["key"] for r in sent] == ["A", "B"]
    aside = {(r["record"], r["reason"]) for r in read_rejects(spark, f"{tmp_path}/rejects").collect()}
    assert aside == {("broken", NOT_JSON), ("7", NO_PASSAGE)}


def messages(spark, path, *items):
    """Messages (text, hour) added to a folder of Parquet files, as a stream."""
    rows = spark.createDataFrame([(t, f"2026-03-05 {h:02d}:10:00") for t, h in items], "value string, at string")
    rows.selectExpr("CAST(value AS BINARY) AS value", "CAST(at AS TIMESTAMP) AS timestamp").coalesce(1).write.mode("append").parquet(path)
    return stream_files(spark, path, "value binary, timestamp timestamp")


def test_archive_keeps_texts_and_restarts(spark, tmp_path):
    for batch in ([('{"gid":1,"x":2}', 4), ("{", 4)], [('{"gid":2}', 23), ('{"gid":3}', 4)], []):
        stream = messages(spark, f"{tmp_path}/in", *batch) if batch else stream_files(spark, f"{tmp_path}/in", "value binary, timestamp timestamp")
        run_to_end(archive_job(stream, f"{tmp_path}/lake", f"{tmp_path}/c"))
    lake = read_lake(spark, f"{tmp_path}/lake", 2026, 3)
    assert {(r["gid"], r["record"], r["hour"]) for r in lake.collect()} == {
        ("1", '{"gid":1,"x":2}', 4), ("2", '{"gid":2}', 23), ("3", '{"gid":3}', 4)
    }
    assert [r["record"] for r in read_rejects(spark, f"{tmp_path}/lake-rejects").collect()] == ["{"]
    assert read_lake(spark, f"{tmp_path}/lake", 2026, 4).count() == 0


def test_repeated_micro_batch_replaces_itself(spark, tmp_path):
    stream = messages(spark, f"{tmp_path}/in", ('{"gid":1}', 4), ("{", 4))
    run_to_end(archive_job(stream, f"{tmp_path}/lake", f"{tmp_path}/c"))
    (commit,) = [x for x in (tmp_path / "c").rglob("commits/0")]
    commit.unlink()  # as after a failure between the write and the commit
    (commit.parent / ".0.crc").unlink(missing_ok=True)
    run_to_end(archive_job(stream, f"{tmp_path}/lake", f"{tmp_path}/c"))
    assert read_lake(spark, f"{tmp_path}/lake").count() == 1
    assert read_rejects(spark, f"{tmp_path}/lake-rejects").count() == 1


def test_removed_checkpoint_is_refused(spark, tmp_path):
    stream = messages(spark, f"{tmp_path}/in", ('{"gid":1}', 4))
    run_to_end(archive_job(stream, f"{tmp_path}/lake", f"{tmp_path}/c"))
    (tmp_path / "c").rename(tmp_path / "gone")
    with pytest.raises(ValueError, match="another checkpoint"):
        archive_job(stream, f"{tmp_path}/lake", f"{tmp_path}/c")


def passage_rows(spark, ids, day="2026-03-05"):
    rows = spark.createDataFrame([(i, f"{day} 07:00:00") for i in ids], "gid bigint, at string")
    return rows.selectExpr("gid", "'C7' AS ligne", "CAST(at AS TIMESTAMP) AS kafka_ts")


def root_files(spark, lake, ids, padded=True, **columns):
    """Files in hour folders at the root, all text, as the feed's other archiver writes them."""
    month = "03" if padded else "3"
    rows = passage_rows(spark, ids).selectExpr("CAST(gid AS STRING) AS gid", "'None' AS ligne", *[f"'{v}' AS {k}" for k, v in columns.items()])
    rows.write.mode("append").parquet(f"{lake}/year=2026/month={month}/day=05/hour=07")


def ids(df):
    return sorted(int(r["gid"]) for r in df.collect())


@pytest.mark.parametrize("padded", [True, False])
def test_lake_with_root_folders_and_writers(spark, tmp_path, padded):
    lake = f"{tmp_path}/lake"
    root_files(spark, lake, [1, 2], padded)
    assert ids(read_lake(spark, lake)) == [1, 2]
    backfill_archive(passage_rows(spark, [3]), lake)
    backfill_archive(passage_rows(spark, [9], "2025-03-05"), lake)
    root_files(spark, lake, [4], padded, last_updated_fme="u", quai="q")
    stream = passage_rows(spark, [5])
    stream.write.parquet(f"{tmp_path}/in")
    run_to_end(archive(stream_files(spark, f"{tmp_path}/in", stream.schema), lake, f"{tmp_path}/c"))
    found = read_lake(spark, lake, 2026, 3, extra=["quai"])
    assert ids(found) == [1, 2, 3, 4, 5]
    assert {r["gid"]: (r["last_updated_fme"], r["quai"]) for r in found.collect()}["4"] == ("u", "q")
    assert {tuple(r) for r in found.select(*ARCHIVE_PARTS).collect()} == {(2026, 3, 5, 7)}
    assert ids(read_lake(spark, lake)) == [1, 2, 3, 4, 5, 9]
    assert ids(read_lake(spark, lake, 2025)) == [9] and ids(read_lake(spark, lake, month=3)) == [1, 2, 3, 4, 5, 9]
    assert ids(read_lake(spark, lake, 2024)) == []


def test_streams_that_have_written_nothing(spark, tmp_path):
    lake, schema = f"{tmp_path}/lake", passage_rows(spark, []).schema
    (tmp_path / "in").mkdir()
    empty = stream_files(spark, f"{tmp_path}/in", schema)
    query = archive(empty, lake, f"{tmp_path}/c1").trigger(processingTime="1 second").start()
    query.stop()
    run_to_end(append_table(empty, f"{tmp_path}/t", f"{tmp_path}/c2"))
    (tmp_path / "lake").mkdir(exist_ok=True)
    (tmp_path / "lake" / "writer=started" / "_spark_metadata").mkdir(parents=True)
    assert read_lake(spark, lake).count() == 0
    backfill_archive(passage_rows(spark, [1]), lake)
    assert ids(read_lake(spark, lake, 2026, 3)) == [1]
    (tmp_path / "t" / "writer=started" / "_spark_metadata").mkdir(parents=True)
    assert read_written(spark, f"{tmp_path}/t", schema).count() == 0
    with pytest.raises(FileNotFoundError):
        read_written(spark, f"{tmp_path}/t")
    passage_rows(spark, [2]).write.parquet(f"{tmp_path}/t/writer=batch")
    assert ids(read_written(spark, f"{tmp_path}/t")) == [2]
    with pytest.raises(FileNotFoundError):
        read_lake(spark, f"{tmp_path}/nowhere")


def test_cassandra_stream_keeps_rejects(spark, tmp_path):
    rows = spark.createDataFrame([("A", "x"), (None, "x")], "ligne string, direction string")
    rows.write.parquet(f"{tmp_path}/in")
    written = []

    def write(df, table, keyspace, truncate):
        good, rejects = split_rejects(df, table)
        written.extend((keyspace, truncate, r["ligne"]) for r in good.collect())
        return rejects

    stream = stream_files(spark, f"{tmp_path}/in", rows.schema)
    run_to_end(cassandra_table(stream, f"{tmp_path}/c", LINE_STATS, "k", f"{tmp_path}/rejects", write=write))
    assert written == [("k", False, "A")]
    assert [r["direction"] for r in spark.read.parquet(f"{tmp_path}/rejects").where("ligne is null").collect()] == ["x"]


def test_rows_for_cassandra_have_no_null_keys(spark):
    df = spark.createDataFrame([("A", "x", None, None, None)], "ligne string, direction string, route_code string, pmr string, total_passages bigint")
    df = df.selectExpr("*", "timestamp'2024-01-01' AS window_ts", "1.0D AS avg_delay_min", "1L AS realtime_count")
    row = for_cassandra(df, WINDOW_STATS).first()
    assert (row["route_code"], row["pmr"], row["total_passages"]) == ("", "", None)


def test_publish_reads_documents_once_for_both_outputs(spark, tmp_path):
    lines(tmp_path / "in", '{"values":[{"ligne":"A"}]}', "{")
    sent = []
    publish_job(spark, f"{tmp_path}/in", lambda f: sent.extend(f.collect()), f"{tmp_path}/r", one_per_line=True)
    assert [tuple(r) for r in sent] == [("A", '{"ligne":"A"}')]
    assert [r["record"] for r in read_rejects(spark, f"{tmp_path}/r").collect()] == ["{"]


def test_latest_start_takes_new_files_only(spark, tmp_path):
    import time

    passage_rows(spark, [1]).write.mode("append").parquet(f"{tmp_path}/in")
    time.sleep(1.1)
    schema = passage_rows(spark, []).schema

    def run():
        stream = stream_files(spark, f"{tmp_path}/in", schema, latest_for=f"{tmp_path}/c")
        run_to_end(append_table(stream, f"{tmp_path}/out", f"{tmp_path}/c"))
        return read_written(spark, f"{tmp_path}/out", schema)

    assert run().count() == 0
    time.sleep(1.1)
    for k in (2, 3):
        passage_rows(spark, [k]).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(1.1)
    assert ids(run()) == [2, 3] and ids(run()) == [2, 3]


def test_timed_trigger_starts_and_stops(spark, tmp_path):
    import time

    passage_rows(spark, [1]).write.mode("append").parquet(f"{tmp_path}/in")
    schema = passage_rows(spark, []).schema
    query = start(append_table(stream_files(spark, f"{tmp_path}/in", schema), f"{tmp_path}/out", f"{tmp_path}/c"), every="1 second")
    for _ in range(300):
        if any(p["numInputRows"] for p in query.recentProgress):
            break
        time.sleep(0.1)
    assert query.isActive
    finish(query)
    assert not query.isActive and ids(read_written(spark, f"{tmp_path}/out")) == [1]


def test_finish_raises_what_failed(spark, tmp_path):
    passage_rows(spark, [1]).write.parquet(f"{tmp_path}/in")

    def fail(batch, batch_id):
        raise RuntimeError("no such sink")

    stream = stream_files(spark, f"{tmp_path}/in", passage_rows(spark, []).schema)
    query = start(stream.writeStream.option("checkpointLocation", f"{tmp_path}/c").foreachBatch(fail), every="1 second")
    with pytest.raises(Exception, match="no such sink"):
        query.awaitTermination(60)
        finish(query)
