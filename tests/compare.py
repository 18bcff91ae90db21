"""Comparison of a Spark result with DuckDB's, as sorted rows."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    found = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(found, key=lambda row: tuple((v is not None, str(v)) for v in row))


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def duckdb_rows(con, sql):
    cursor = con.execute(sql)
    return _rows([d[0] for d in cursor.description], cursor.fetchall())


def kinds(con, sql) -> dict[str, str]:
    return {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
