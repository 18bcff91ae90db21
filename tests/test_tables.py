import os
import tempfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from stoplens.__main__ import main
from stoplens.operators import changes, line_stats
from stoplens.schemas import LINE_STATS, WINDOW_STATS
from stoplens.session import work_dir
from stoplens.sinks import archive, backfill_archive, compact_serving, write_serving
from stoplens.sinks.writers import stream_folder
from stoplens.sources import read_lake, read_serving, read_written, stream_files
from stoplens.streaming import run_to_end
from workload.fixtures import passages
from workload.queries import as_messages

STATS = "ligne string, direction string, attente_moyenne_min double, attente_max_min float, attente_min_min float, ecart_type_attente double, total_enregistrements bigint"


def stats(spark, *items):
    return spark.createDataFrame([(line, way, mean, 1.0, 1.0, 0.0, 1) for line, way, mean in items], STATS)


def content(spark, path):
    table = read_serving(spark, path, LINE_STATS)
    return {(r["ligne"], r["direction"]): r["attente_moyenne_min"] for r in table.collect()}


def test_upsert_replaces_equal_keys_only(spark, tmp_path):
    path = f"{tmp_path}/table"
    write_serving(stats(spark, ("A", "x", 1.0), ("B", "x", 2.0)), path, LINE_STATS, 1)
    write_serving(stats(spark, ("B", "x", 5.0), ("C", "x", 6.0)), path, LINE_STATS, 2)
    expected = {("A", "x"): 1.0, ("B", "x"): 5.0, ("C", "x"): 6.0}
    assert content(spark, path) == expected
    write_serving(stats(spark, ("B", "x", 5.0), ("C", "x", 6.0)), path, LINE_STATS, 2)
    assert content(spark, path) == expected
    assert read_serving(spark, path, LINE_STATS).schema == LINE_STATS.schema
    compact_serving(spark, path, f"{tmp_path}/compacted", LINE_STATS, 2)
    write_serving(stats(spark, ("A", "x", 9.0)), f"{tmp_path}/compacted", LINE_STATS, 3)
    assert content(spark, f"{tmp_path}/compacted") == {**expected, ("A", "x"): 9.0}


def test_rows_without_a_key_are_kept_apart(spark, tmp_path):
    df = stats(spark, ("A", "x", 1.0), (None, "x", 2.0))
    with pytest.raises(ValueError):
        write_serving(df, f"{tmp_path}/strict", LINE_STATS, 1)
    write_serving(df, f"{tmp_path}/table", LINE_STATS, 1, f"{tmp_path}/rejects")
    assert content(spark, f"{tmp_path}/table") == {("A", "x"): 1.0}
    assert spark.read.parquet(f"{tmp_path}/rejects").count() == 1


def test_stored_newest_window_first(spark, tmp_path):
    df = spark.range(50).selectExpr(
        "timestamp_seconds(id * 600) AS window_ts", "'L' AS ligne", "'D' AS direction", "'r' AS route_code",
        "'p' AS pmr", "1L AS total_passages", "1.0D AS avg_delay_min", "1L AS realtime_count",
    )
    write_serving(df, f"{tmp_path}/t", WINDOW_STATS, 0)
    part = spark.read.parquet(f"{tmp_path}/t").withColumn("p", F.spark_partition_id())
    for _, times in part.groupBy("p").agg(F.collect_list("window_ts")).collect():
        assert times == sorted(times, reverse=True)


def test_serving_filters_reach_the_scan(spark, tmp_path, plan):
    test_stored_newest_window_first(spark, tmp_path)
    table = read_serving(spark, f"{tmp_path}/t", WINDOW_STATS)
    text = plan(table.where(F.col("ligne").isin("L", "M") & (F.col("window_ts") > "1970-01-01 01:00:00")))
    pushed = text[text.index("PushedFilters"):]
    assert "In(ligne" in pushed and "GreaterThan(window_ts" in pushed


def test_lake_month_is_pruned(spark, sf_dir, tmp_path, plan):
    two_years = passages(spark, sf_dir).withColumn(
        "heurepassage", F.expr("heurepassage + make_ym_interval(CAST(gid % 2 AS INT), 0)")
    ).where("day(heurepassage) <= 2")
    backfill_archive(two_years, f"{tmp_path}/lake", "heurepassage", legacy_nulls=True)
    month = read_lake(spark, f"{tmp_path}/lake", 2024, 1)
    text = plan(month)
    assert "(year#" in text[text.index("PartitionFilters"):]
    assert 0 < month.count() < read_lake(spark, f"{tmp_path}/lake").count()
    assert month.where("ligne = 'None'").count() > 0


def test_files_are_cut_at_max_records(spark, sf_dir, tmp_path):
    day = passages(spark, sf_dir).withColumn("heurepassage", F.lit("2024-01-01").cast("timestamp"))
    backfill_archive(day, f"{tmp_path}/lake", "heurepassage", max_records=300)
    assert len(list((tmp_path / "lake").rglob("*.parquet"))) >= 4


def test_line_stats_command(spark, sf_dir, tmp_path):
    feed = passages(spark, sf_dir).where("ligne is not null")
    backfill_archive(feed.where("day(heurepassage) <= 3"), f"{tmp_path}/lake", "heurepassage")
    main(
        ["line-stats", "--lake", f"{tmp_path}/lake", "--year", "2024", "--month", "1",
         "--out", f"{tmp_path}/out", "--write-id", "1"]
    )
    expected = line_stats(feed.where("day(heurepassage) <= 3"))
    found = read_serving(spark, f"{tmp_path}/out", LINE_STATS)
    key = ["ligne", "direction", "total_enregistrements"]
    assert sorted(map(tuple, found.select(*key).collect())) == sorted(map(tuple, expected.select(*key).collect()))


def session_like(master, **settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=settings.get), sparkContext=SimpleNamespace(master=master)
    )


def test_work_dir_is_below_the_shared_folder():
    session = session_like("spark://host", **{"spark.checkpoint.dir": "s3a://bucket/shared/"})
    first, second = work_dir(session, "x"), work_dir(session, "x")
    assert first != second and first.startswith("s3a://bucket/shared/stoplens-x-")


def test_work_dir_is_machine_local_only_on_a_local_master():
    assert work_dir(session_like("local[2]"), "x").startswith(tempfile.gettempdir())
    with pytest.raises(ValueError):
        work_dir(session_like("spark://host"), "x")


def lake_rows(spark, tmp_path):
    return sorted(r["gid"] for r in read_lake(spark, f"{tmp_path}/lake").select("gid").collect())


def test_archive_unites_writers_and_checkpoints(spark, sf_dir, tmp_path):
    feed = passages(spark, sf_dir).where("gid < 60")
    feed.where("gid < 20").write.parquet(f"{tmp_path}/in1")
    feed.where("gid >= 20 AND gid < 40").write.parquet(f"{tmp_path}/in2")
    for k in (1, 2):
        stream = spark.readStream.schema(feed.schema).parquet(f"{tmp_path}/in{k}")
        run_to_end(archive(stream, f"{tmp_path}/lake", f"{tmp_path}/shape{k}", "heurepassage"))
        if k == 1:
            backfill_archive(feed.where("gid >= 40"), f"{tmp_path}/lake", "heurepassage")
    assert lake_rows(spark, tmp_path) == sorted(str(k) for k in range(60) if feed.where(f"gid = {k}").count())


def test_a_log_that_the_checkpoint_does_not_know_is_refused(spark, tmp_path):
    folder = stream_folder(spark, f"{tmp_path}/lake", f"{tmp_path}/c")
    os.makedirs(f"{folder}/_spark_metadata")
    with pytest.raises(ValueError, match="another checkpoint"):
        stream_folder(spark, f"{tmp_path}/lake", f"{tmp_path}/c")
    os.makedirs(f"{tmp_path}/c/metadata")
    assert stream_folder(spark, f"{tmp_path}/lake", f"{tmp_path}/c") == folder
    assert stream_folder(spark, f"{tmp_path}/lake", f"{tmp_path}/c2") != folder


@pytest.mark.parametrize("arguments", [["--lake", "x"], ["--lake", "x", "--out", "y"]])
def test_line_stats_needs_a_write_id_and_a_place(arguments):
    with pytest.raises(SystemExit):
        main(["line-stats", *arguments])


@pytest.mark.parametrize(
    "arguments",
    [
        ["line-stats", "--lake", "x", "--cassandra-keyspace", "k"],
        ["live-stats", "--servers", "s", "--topic", "t", "--checkpoint", "c", "--routes", "r", "--cassandra-keyspace", "k"],
        ["live-stats", "--servers", "s", "--topic", "t", "--checkpoint", "c", "--routes", "r", "--out", "o", "--dedup-key", "id"],
        ["publish", "--snapshots", "x", "--servers", "s", "--topic", "t", "--rejects", "r", "--follow"],
        ["publish", "--snapshots", "x", "--servers", "s", "--topic", "t"],
    ],
)
def test_commands_say_what_is_missing(arguments):
    with pytest.raises(SystemExit):
        main(arguments)


@pytest.mark.parametrize("state", [[], ["--slice-width", "60"]])
def test_changes_command(spark, sf_dir, tmp_path, monkeypatch, state):
    """The command line over files in place of a topic."""
    import stoplens.__main__ as command

    as_messages(passages(spark, sf_dir).where("gid < 200")).write.parquet(f"{tmp_path}/in")
    monkeypatch.setattr(command, "stream_kafka", lambda session, *_: stream_files(session, f"{tmp_path}/in", "value binary, timestamp timestamp"))
    stream = ["--servers", "s", "--topic", "t", "--checkpoint", f"{tmp_path}/c", "--out", f"{tmp_path}/out", "--drain"]
    main(["changes", *stream, "--order", "gid", *state])
    found = read_written(spark, f"{tmp_path}/out").select("event", "id", "gid", "old_value", "new_value")
    expected = changes(passages(spark, sf_dir).where("gid < 200")).select("event", "id", "gid", "old_value", "new_value")
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))


def test_archive_command(spark, sf_dir, tmp_path, monkeypatch):
    import stoplens.__main__ as command

    as_messages(passages(spark, sf_dir).where("gid < 50")).write.parquet(f"{tmp_path}/in")
    monkeypatch.setattr(command, "stream_kafka", lambda session, *_: stream_files(session, f"{tmp_path}/in", "value binary, timestamp timestamp"))
    stream = ["--servers", "s", "--topic", "t", "--checkpoint", f"{tmp_path}/c", "--out", f"{tmp_path}/lake", "--drain"]
    main(["archive", *stream, "--max-records", "5"])
    count = passages(spark, sf_dir).where("gid < 50").count()
    assert read_lake(spark, f"{tmp_path}/lake").count() == count
    assert len(list((tmp_path / "lake").rglob("*.parquet"))) >= count / 5


def test_write_ids_are_numbers(spark, tmp_path):
    with pytest.raises(TypeError):
        write_serving(spark.range(1), f"{tmp_path}/t", LINE_STATS, None)
