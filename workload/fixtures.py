"""The feed's inputs as views over the test tables.

``passages`` is a projection of ``events``, so it works on a stream of events
as well. It covers every form of wait text, missing lines, repeated ids and
repeated (id, stamp) pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)

# Shared by Spark and DuckDB; {k}, {text} and {time} differ by engine.
PASSAGE_COLUMNS = {
    "gid": "event_id",
    "id": "CAST(user_id * 10 + k % 10 AS {text})",
    "ligne": "CASE user_id % 5 WHEN 0 THEN 'C7' WHEN 1 THEN '93' WHEN 2 THEN 'T1' WHEN 3 THEN 'C3' END",
    "direction": (
        "CASE event_type WHEN 'click' THEN 'Gare Part-Dieu' WHEN 'view' THEN 'Bellecour' "
        "WHEN 'purchase' THEN 'Vers Bellecour' WHEN 'signup' THEN 'Perrache' ELSE 'Gorge de Loup' END"
    ),
    "delaipassage": (
        "CASE k % 10 WHEN 0 THEN 'Proche' WHEN 1 THEN {label} "
        "WHEN 2 THEN concat(CAST(1 + k % 3 AS {text}), 'h', lpad(CAST(k % 60 AS {text}), 2, '0')) "
        "WHEN 3 THEN NULL WHEN 4 THEN 'None' WHEN 5 THEN concat(CAST(k % 30 AS {text}), 'min') "
        "ELSE concat(CAST(CAST(floor(value) AS INT) % 30 AS {text}), ' min') END"
    ),
    "type": "CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'E' ELSE 'T' END",
    "heurepassage": "{time}",
    "last_update_fme": "substr(CAST(ts AS {text}), 1, 13)",
}

SPARK_WORDS = {"text": "STRING", "label": '"A l\'arret"', "time": "CAST(ts AS TIMESTAMP)"}
DUCKDB_WORDS = {"text": "VARCHAR", "label": "'A l''arret'", "time": "ts"}

ROUTES_ROWS = """
 ('C7','c7a','Bellecour','Aller','A','B','True'), ('C7','c7b','Gare Part-Dieu','Retour','B','A','False'),
 ('93','93a','Perrache','Aller','C','D','True'),  ('93','93b','Bellecour','Retour','D','C','True'),
 ('T1','t1a',NULL,'Aller','E','F','False'),
 ('C3','c3a','Gare','Aller','G','H','True'),      ('C3','c3b','Gare Part','Retour','H','G','False')
"""
ROUTES_SQL = (
    f"SELECT * FROM (VALUES {ROUTES_ROWS}) "
    "AS t(ligne, code_trace, nom_trace, sens, nom_origine, nom_destination, pmr)"
)

# A routes table that grows with the data, for the file scan.
PART_ROUTES = {
    "ligne": "concat('L', CAST(p_size AS {text}))",
    "code_trace": "concat('r', CAST(p_partkey AS {text}))",
    "nom_trace": "CASE WHEN p_partkey % 7 <> 0 THEN p_name END",
    "sens": "CASE p_partkey % 2 WHEN 0 THEN 'Aller' ELSE 'Retour' END",
    "nom_origine": "p_brand",
    "nom_destination": "p_type",
    "pmr": "CASE WHEN p_size % 3 = 0 THEN 'True' WHEN p_size % 3 = 1 THEN 'False' END",
}

# Passages and routes that both grow: a direction names one route by its number. Most are of
# one line, some have no line or name, and some names are shorter than the index's key.
NAMED_PASSAGES = {
    "gid": "event_id",
    "ligne": "CASE event_id % 9 WHEN 0 THEN NULL WHEN 1 THEN '93' WHEN 2 THEN '93' ELSE 'C7' END",
    "direction": (
        "CASE WHEN event_id % 7 <> 0 THEN concat('Vers ', p_name, ' ', lpad(CAST(p_partkey AS {text}), 9, '0'), ' centre') END"
    ),
}
NAMED_ROUTES = {
    **PART_ROUTES,
    "ligne": "CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '93' ELSE 'C7' END",
    "nom_trace": (
        "CASE WHEN p_partkey % 6 = 0 THEN NULL WHEN p_partkey % 97 = 50 THEN lpad(CAST(p_partkey AS {text}), 7, '0') "
        "ELSE concat(p_name, ' ', lpad(CAST(p_partkey AS {text}), 9, '0')) END"
    ),
}


def columns_sql(columns: dict[str, str], words: dict[str, str]) -> list[str]:
    return [f"{text.format(**words)} AS {name}" for name, text in columns.items()]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def as_passages(events: DataFrame) -> DataFrame:
    keyed = events.selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")
    return keyed.selectExpr(*columns_sql(PASSAGE_COLUMNS, SPARK_WORDS))


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_passages(events(spark, sf_dir))


def routes(spark: SparkSession) -> DataFrame:
    return spark.sql(ROUTES_SQL)


def part_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    return parts.selectExpr(*columns_sql(PART_ROUTES, SPARK_WORDS))


def named_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name")
    named = events(spark, sf_dir).join(parts, F.expr(f"p_partkey = event_id % {parts.count()}"))
    return named.selectExpr(*columns_sql(NAMED_PASSAGES, SPARK_WORDS))


def named_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    return parts.selectExpr(*columns_sql(NAMED_ROUTES, SPARK_WORDS))


DUCKDB_NAMED_PASSAGES = (
    "SELECT " + ", ".join(columns_sql(NAMED_PASSAGES, DUCKDB_WORDS))
    + " FROM events JOIN part ON p_partkey = event_id % (SELECT count(*) FROM part)"
)
DUCKDB_NAMED_ROUTES = "SELECT " + ", ".join(columns_sql(NAMED_ROUTES, DUCKDB_WORDS)) + " FROM part"
DUCKDB_PASSAGES = (
    "SELECT " + ", ".join(columns_sql(PASSAGE_COLUMNS, DUCKDB_WORDS))
    + " FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)"
)
DUCKDB_PART_ROUTES = "SELECT " + ", ".join(columns_sql(PART_ROUTES, DUCKDB_WORDS)) + " FROM part"
