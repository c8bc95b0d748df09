"""Compare a query with its SQL twin: columns by name, rows in any order."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _rows(names: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


def spark_rows(df) -> tuple[list[str], list[str]]:
    return _rows(df.columns, [tuple(row) for row in df.collect()])


def oracle_rows(db: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[str]]:
    result = db.execute(sql)
    return _rows([c[0] for c in result.description], result.fetchall())
