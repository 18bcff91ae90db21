"""The SQL (DuckDB) each query is compared with, over the same tables."""

from __future__ import annotations

from .fixtures import DUCKDB_NAMED_PASSAGES, DUCKDB_NAMED_ROUTES, DUCKDB_PART_ROUTES, DUCKDB_PASSAGES, ROUTES_SQL
from .queries import DOCUMENT, MESSAGE, MID_MONTH, PASSAGE, SNAPSHOT_SIZE, STAGE, STAGES

FIRST_INT = r"try_cast(regexp_extract(delaipassage, '(\d+)', 1) AS FLOAT)"
DELAY = r"""CASE
  WHEN regexp_matches(delaipassage, '^\d+\s*min$') THEN CAST(regexp_extract(delaipassage, '(\d+)', 1) AS DOUBLE)
  WHEN regexp_matches(delaipassage, '^\d+h\d+$')
    THEN CAST(regexp_extract(delaipassage, '^(\d+)h', 1) AS DOUBLE) * 60
       + CAST(regexp_extract(delaipassage, 'h(\d+)$', 1) AS DOUBLE)
  WHEN delaipassage = 'Proche' THEN 0.5
  WHEN delaipassage = 'A l''arret' THEN 0.0
END"""

PASSAGES = f"WITH passages AS ({DUCKDB_PASSAGES}), routes AS ({ROUTES_SQL})"

FIRST_SEEN = """, first_seen AS (
  SELECT * EXCLUDE (rank) FROM (
    SELECT *, row_number() OVER (PARTITION BY id, last_update_fme ORDER BY gid) AS rank FROM passages)
  WHERE rank = 1)"""


def enriched(source: str) -> str:
    return f""", enriched AS (
  SELECT p.*, r.code_trace AS route_code, r.nom_trace AS route_name, r.nom_origine, r.nom_destination, r.pmr
  FROM {source} p LEFT JOIN routes r
    ON p.ligne = r.ligne AND contains(p.direction, substr(r.nom_trace, 1, 50)))"""


WINDOW_COLUMNS = f"""time_bucket(INTERVAL '10 minutes', heurepassage) AS window_ts, ligne, direction, route_code, pmr,
    count(*) AS total_passages, avg({DELAY}) AS avg_delay_min,
    count(CASE WHEN type = 'E' THEN 1 END) AS realtime_count"""


def windows(source: str = "passages") -> str:
    return f"""{enriched(source)}, windows AS (
  SELECT {WINDOW_COLUMNS} FROM enriched GROUP BY 1, 2, 3, 4, 5)"""


STORED = """, stored AS (
  SELECT window_ts, ligne, direction, route_code, pmr, total_passages,
    CAST(avg_delay_min AS FLOAT) AS avg_delay_min, realtime_count
  FROM windows WHERE ligne IS NOT NULL AND direction IS NOT NULL)"""


def stats_by(groups: str, source: str, wait: str = "attente_min") -> str:
    return f"""SELECT {groups}, round(avg({wait}), 2) AS attente_moyenne_min, max({wait}) AS attente_max_min,
  min({wait}) AS attente_min_min, coalesce(round(stddev_samp({wait}), 2), 0.0) AS ecart_type_attente,
  count(*) AS total_enregistrements FROM {source} GROUP BY {groups}"""


def line_stats(source: str, parser: str = FIRST_INT, max_wait: int = 15) -> str:
    live = f"""(SELECT * FROM (SELECT ligne, direction, {parser} AS attente_min FROM (
      SELECT *, row_number() OVER (PARTITION BY id, last_update_fme ORDER BY gid) AS rank FROM {source})
    WHERE rank = 1 AND type = 'E' AND delaipassage IS NOT NULL) WHERE attente_min <= {max_wait})"""
    return stats_by("ligne, direction", live)


def changes(key: str = "id", order: str = "gid", shown: str = "gid") -> str:
    return f"""{PASSAGES}, ordered AS (
  SELECT *, row_number() OVER seen AS nth, lag(delaipassage) OVER seen AS old_value
  FROM (SELECT * REPLACE ({key} AS id), heurepassage AS kafka_ts, {STAGE} AS stage FROM passages)
  WINDOW seen AS (PARTITION BY id ORDER BY {order}))
SELECT CASE WHEN nth = 1 THEN 'NEW' ELSE 'UPDATE' END AS event, id, {shown}, ligne, direction, heurepassage,
  old_value, delaipassage AS new_value
FROM ordered WHERE nth = 1 OR old_value IS DISTINCT FROM delaipassage"""


PARTS = """strftime(heurepassage, '%Y') AS year, strftime(heurepassage, '%m') AS month,
  strftime(heurepassage, '%d') AS day, strftime(heurepassage, '%H') AS hour"""

# A stage's rows are late when an earlier stage moved the watermark past the
# end of their window.
TIMELY = f""", staged AS (SELECT *, {STAGE} AS stage FROM passages),
marks AS (SELECT s.stage, max(m.heurepassage) - INTERVAL '10 minutes' AS watermark
  FROM (SELECT unnest(generate_series(0, {STAGES - 1})) AS stage) s
  LEFT JOIN staged m ON m.stage < s.stage GROUP BY 1),
timely AS (SELECT s.* EXCLUDE (stage) FROM staged s JOIN marks USING (stage)
  WHERE watermark IS NULL
     OR time_bucket(INTERVAL '10 minutes', heurepassage) + INTERVAL '10 minutes' > watermark)"""

FIELDS = ", ".join(
    f"'{c}', " + (f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%fZ')" if c == "heurepassage" else c) for c in PASSAGE
)
RECORDS = f""", records AS (
  SELECT *, CAST(json_object({FIELDS}, 'quai', concat('Q', CAST(gid % 5 AS VARCHAR)),
    'infos', json_object('niveau', gid % 3, 'texte', ligne)) AS VARCHAR) AS record FROM passages)"""
KEY = "coalesce(ligne, CAST(gid AS VARCHAR), '0') AS key"

SINCE = "TIMESTAMP '" + MID_MONTH + "'"

ORACLES: dict[str, str] = {
    "passages": f"{PASSAGES} SELECT * FROM passages",
    "routes_scan": DUCKDB_PART_ROUTES,
    "snapshot_explode": f"{PASSAGES} SELECT * FROM passages",
    "snapshot_publish": f"{PASSAGES}{RECORDS} SELECT {KEY}, gid, record AS value FROM records",
    "corrupt_documents": f"""{PASSAGES}{RECORDS}, polls AS (
  SELECT gid // {SNAPSHOT_SIZE} AS poll, concat('{{"values":[', string_agg(record, ',' ORDER BY gid), ']}}') AS whole
  FROM records GROUP BY 1)
SELECT record, NULL AS reason FROM records WHERE (gid // {SNAPSHOT_SIZE}) % 5 IN (0, 3)
UNION ALL SELECT {DOCUMENT.format(text="VARCHAR")}, 'not a JSON object' FROM polls WHERE poll % 5 IN (1, 2)
UNION ALL SELECT unnest([concat('text ', CAST(poll AS VARCHAR)), CAST(poll AS VARCHAR), NULL]),
  'values hold no object here' FROM polls WHERE poll % 5 = 3""",
    "archived_records": f"""{PASSAGES}{RECORDS} SELECT {MESSAGE} AS record,
  CASE WHEN gid % 50 < 2 THEN 'not a JSON object' END AS reason,
  CASE WHEN gid % 50 > 2 THEN CAST(gid AS VARCHAR) END AS gid, CASE WHEN gid % 50 > 1 THEN ligne END AS ligne,
  CAST(hour(heurepassage) AS INT) AS hour FROM records""",
    "lake_root_layout": f"""{PASSAGES} SELECT * REPLACE (nullif(delaipassage, 'None') AS delaipassage),
  CAST(year(heurepassage) AS INT) AS year, CAST(month(heurepassage) AS INT) AS month,
  CAST(day(heurepassage) AS INT) AS day, CAST(hour(heurepassage) AS INT) AS hour FROM passages""",
    "snapshot_publish_stream": f"{PASSAGES} SELECT * FROM passages",
    "publish_keyed": f"""{PASSAGES} SELECT coalesce(ligne, CAST(gid AS VARCHAR), '0') AS key, gid, id, ligne,
  direction, delaipassage, type, last_update_fme, 'absent' AS coursetheorique FROM passages""",
    "decode_passages": f"{PASSAGES} SELECT *, heurepassage AS kafka_ts FROM passages",
    "stringify_all": f"{PASSAGES} SELECT CAST(COLUMNS(*) AS VARCHAR) FROM passages",
    "stringify_legacy_nulls": f"""{PASSAGES}
SELECT coalesce(CAST(COLUMNS(* EXCLUDE (heurepassage)) AS VARCHAR), 'None') FROM passages""",
    "arrival_parts": f"{PASSAGES} SELECT gid, {PARTS} FROM passages",
    "archive_roundtrip": f"""{PASSAGES}, parts AS (SELECT *, {PARTS} FROM passages)
SELECT CAST(COLUMNS(* EXCLUDE (year, month, day, hour)) AS VARCHAR),
  CAST(year AS INT) AS year, CAST(month AS INT) AS month, CAST(day AS INT) AS day, CAST(hour AS INT) AS hour
FROM parts""",
    "lake_month_scan": f"""{PASSAGES}, late AS (
  SELECT *, heurepassage + INTERVAL 1 MONTH AS arrival FROM passages WHERE heurepassage >= {SINCE})
SELECT CAST(COLUMNS(* EXCLUDE (arrival)) AS VARCHAR), CAST(year(arrival) AS INT) AS year,
  CAST(month(arrival) AS INT) AS month, CAST(day(arrival) AS INT) AS day, CAST(hour(arrival) AS INT) AS hour
FROM late""",
    "lake_line_stats": f"{PASSAGES} {line_stats('passages')}",
    # The archive's text for a missing value survives as a NULL line.
    "replayed_archive": f"{PASSAGES} {line_stats('passages')}",
    "parse_first_int": f"{PASSAGES} SELECT gid, delaipassage, {FIRST_INT} AS attente_min FROM passages",
    "parse_delay": f"{PASSAGES} SELECT gid, delaipassage, {DELAY} AS delai_minutes FROM passages",
    "dedup_observations": f"{PASSAGES}{FIRST_SEEN} SELECT * FROM first_seen",
    "dedup_stream": f"{PASSAGES} SELECT DISTINCT id, last_update_fme FROM passages",
    "realtime_rows": f"""{PASSAGES}{FIRST_SEEN}
SELECT * FROM first_seen WHERE type = 'E' AND delaipassage IS NOT NULL""",
    "short_waits": f"""{PASSAGES} SELECT * FROM (
  SELECT gid, ligne, direction, {FIRST_INT} AS attente_min FROM passages
  WHERE type = 'E' AND delaipassage IS NOT NULL) WHERE attente_min <= 15""",
    "fill_missing": f"""{PASSAGES} {stats_by('id', f'(SELECT id, {FIRST_INT} AS attente_min FROM passages)')}""",
    "batch_line_stats": f"{PASSAGES} {line_stats('passages')}",
    "line_stats_delay_text": f"{PASSAGES} {line_stats('passages', DELAY, 90)}",
    "route_enrich": f"{PASSAGES}{enriched('passages')} SELECT * FROM enriched",
    "route_enrich_shuffled": f"{PASSAGES}{enriched('passages')} SELECT * FROM enriched",
    "route_enrich_indexed": f"""WITH passages AS ({DUCKDB_NAMED_PASSAGES}), routes AS ({DUCKDB_NAMED_ROUTES})
{enriched("passages")} SELECT * FROM enriched""",
    "conditional_count": f"""{PASSAGES} SELECT ligne, direction, count(*) AS total_passages,
  count(CASE WHEN type = 'E' THEN 1 END) AS realtime_count FROM passages GROUP BY ligne, direction""",
    "window_stats": f"{PASSAGES}{windows()} SELECT * FROM windows",
    "window_stats_dedup": f"{PASSAGES}{FIRST_SEEN}{windows('first_seen')} SELECT * FROM windows",
    "window_stats_collapsed": f"""{PASSAGES}{windows()} SELECT * EXCLUDE (rank) FROM (
  SELECT *, row_number() OVER (PARTITION BY window_ts, ligne, direction
    ORDER BY total_passages DESC, route_code NULLS FIRST, pmr NULLS FIRST) AS rank FROM windows) WHERE rank = 1""",
    "window_stats_stream": f"{PASSAGES}{windows()} SELECT * FROM windows",
    "window_stats_append": f"""{PASSAGES}{windows()} SELECT * FROM windows
WHERE window_ts + INTERVAL '10 minutes' <= (SELECT max(heurepassage) FROM passages) - INTERVAL '10 minutes'""",
    "window_stats_update": f"{PASSAGES}{windows()}{STORED} SELECT * FROM stored",
    "late_rows": f"""{PASSAGES}{TIMELY}{windows('timely')} SELECT * FROM windows
WHERE window_ts + INTERVAL '10 minutes' <= (SELECT max(heurepassage) FROM passages) - INTERVAL '10 minutes'""",
    "change_events": changes(),
    "change_events_sliced": changes("ligne"),
    "change_events_stream": changes(),
    "change_events_staged": changes(order="stage, kafka_ts, delaipassage NULLS FIRST", shown="kafka_ts"),
    "serving_upsert": f"""{PASSAGES}, late AS (
  SELECT * FROM passages WHERE heurepassage >= {SINCE} AND ligne <> 'T1'),
month_stats AS ({line_stats('passages')}), late_stats AS ({line_stats('late')}),
merged AS (SELECT * FROM late_stats UNION ALL
  SELECT m.* FROM month_stats m ANTI JOIN late_stats l ON m.ligne = l.ligne AND m.direction = l.direction)
SELECT ligne, direction, CAST(attente_moyenne_min AS FLOAT) AS attente_moyenne_min,
  CAST(attente_max_min AS FLOAT) AS attente_max_min, CAST(attente_min_min AS FLOAT) AS attente_min_min,
  CAST(ecart_type_attente AS FLOAT) AS ecart_type_attente,
  CAST(total_enregistrements AS INT) AS total_enregistrements
FROM merged WHERE ligne IS NOT NULL AND direction IS NOT NULL""",
    "contract_violations": f"""{PASSAGES}{windows()}, keyed AS (
  SELECT ligne, direction, window_ts, count(*) AS n_rows FROM windows GROUP BY ALL)
SELECT 'null_key' AS violation, * FROM keyed WHERE ligne IS NULL OR direction IS NULL OR window_ts IS NULL
UNION ALL SELECT 'duplicate_key', * FROM keyed WHERE n_rows > 1""",
    "serving_rejects": f"{PASSAGES}{windows()} SELECT * FROM windows WHERE ligne IS NULL OR direction IS NULL",
    "serving_scan": f"{PASSAGES}{windows()}{STORED} SELECT * FROM stored",
    "serving_filter": f"""{PASSAGES}{windows()}{STORED} SELECT window_ts, ligne, avg_delay_min FROM stored
WHERE ligne IN ('C7', '93') AND window_ts > {SINCE}""",
    "serving_latest": f"""{PASSAGES}{windows()}{STORED} SELECT * EXCLUDE (rank) FROM (
  SELECT *, row_number() OVER (PARTITION BY ligne, direction
    ORDER BY window_ts DESC, total_passages DESC, route_code NULLS FIRST, pmr NULLS FIRST) AS rank
  FROM stored) WHERE rank = 1""",
}
