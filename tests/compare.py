"""Compare a registered query with its SQL twin, value by value."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value) -> str:
    if value is None or value != value:
        return "∅"
    if isinstance(value, float):
        return f"{value:.6g}"
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def oracle_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    con.execute(sql)
    columns = [c[0] for c in con.description]
    return sorted(columns), rows_of(columns, con.fetchall())
