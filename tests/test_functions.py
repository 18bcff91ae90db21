import datetime

from pyspark.sql import functions as F

from stoplens.functions import (
    delay_minutes,
    first_int_minutes,
    json_field,
    publish_key,
    stringify,
)
from stoplens.schemas import FEED_SCHEMA
from stoplens.sinks import publish_frame
from stoplens.sources import decode, explode_snapshot, read_routes, read_snapshots, typed_passages

WAITS = [
    ("5 min", 5.0, 5.0),
    ("5min", 5.0, 5.0),
    ("1h05", 1.0, 65.0),
    ("12h0", 12.0, 720.0),
    ("Proche", None, 0.5),
    ("A l'arret", None, 0.0),
    ("None", None, None),
    (None, None, None),
    ("", None, None),
    ("proche", None, None),
    ("1h05 min", 1.0, None),
    ("100 min", 100.0, 100.0),
    ("15 min\n", 15.0, 15.0),
]


def test_both_readings_of_a_wait(spark):
    df = spark.createDataFrame([(w[0],) for w in WAITS], "wait string")
    rows = df.select("wait", first_int_minutes("wait"), delay_minutes("wait")).collect()
    assert [tuple(row) for row in rows] == WAITS


def test_reading_types(spark):
    df = spark.createDataFrame([("5 min",)], "wait string")
    kinds = [k for _, k in df.select(first_int_minutes("wait"), delay_minutes("wait")).dtypes]
    assert kinds == ["float", "double"]


def test_publish_key_falls_back(spark):
    df = spark.createDataFrame([("C7", 1), (None, 2), (None, None)], "ligne string, gid bigint")
    assert [r[0] for r in df.select(publish_key()).collect()] == ["C7", "2", "0"]


def test_published_value_keeps_nulls(spark):
    df = spark.createDataFrame([(None, 2)], "ligne string, gid bigint")
    assert publish_frame(df).first()["value"] == '{"ligne":null,"gid":2}'


def test_json_field_default(spark):
    df = spark.createDataFrame([('{"a":1}',), ('{"a":null}',), ("{}",)], "text string")
    assert [r[0] for r in df.select(json_field("text", "a", "0")).collect()] == ["1", "0", "0"]


def test_stringify(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert tuple(stringify(df).first()) == ("1", None)
    assert tuple(stringify(df, legacy_nulls=True).first()) == ("1", "None")


def messages(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return df.select(F.col("text").cast("binary").alias("value"), F.lit(None).cast("timestamp").alias("timestamp"))


def test_decode_edges(spark):
    texts = [
        '{"id":1,"heurepassage":"2026-03-23 09:01:02","ligne":"C7","extra":1}',
        '{"id":"7","heurepassage":"2026-03-23T09:01:02+01:00","ligne":93}',
        '{"id":"abc","heurepassage":"bad","gid":"x","ligne":null}',
        "not json",
        None,
    ]
    rows = decode(messages(spark, texts)).select("id", "heurepassage", "ligne", "gid").collect()
    assert [tuple(r) for r in rows] == [
        ("1", datetime.datetime(2026, 3, 23, 9, 1, 2), "C7", None),
        ("7", datetime.datetime(2026, 3, 23, 8, 1, 2), "93", None),
        ("abc", None, None, None),
        (None, None, None, None),
        (None, None, None, None),
    ]


def test_decode_accepts_both_stamp_names(spark):
    texts = ['{"last_update_fme":"a"}', '{"last_updated_fme":"b"}', "{}"]
    df = decode(messages(spark, texts))
    assert "last_updated_fme" not in df.columns
    assert [r[0] for r in df.select("last_update_fme").collect()] == ["a", "b", None]


def test_snapshot_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{\n "nb_results": 2,\n "values": [\n {"id": 1, "ligne": "C7"},\n {"id": 2}]}'
    )
    (tmp_path / "b.json").write_text('{"values": []}')
    (tmp_path / "c.json").write_text('{"other": 1}')
    rows = explode_snapshot(read_snapshots(spark, str(tmp_path))).select("id", "ligne").collect()
    assert sorted(tuple(r) for r in rows) == [("1", "C7"), ("2", None)]


def test_routes_empty_fields_are_null(spark, tmp_path):
    path = tmp_path / "routes.csv"
    path.write_text(
        "ligne;code_trace;nom_trace;sens;nom_origine;nom_destination;pmr\nC7;c7a;;Aller;A;B;True\n"
    )
    assert tuple(read_routes(spark, str(path)).first()) == ("C7", "c7a", None, "Aller", "A", "B", "True")


def test_typed_passages_reads_missing_texts(spark):
    df = spark.createDataFrame(
        [("1", "None", "nan", "2024-01-01 00:00:00", "x")],
        "gid string, ligne string, direction string, heurepassage string, idtarretdestination string",
    )
    row = typed_passages(df).first()
    assert tuple(row) == (1, None, None, datetime.datetime(2024, 1, 1), None)
    assert set(typed_passages(df).dtypes) <= {(f.name, f.dataType.simpleString()) for f in FEED_SCHEMA}
