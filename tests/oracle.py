"""Compare a query with its SQL twin run by DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_by_name(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def check(frame, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    expected = con.execute(sql)
    want = rows_by_name([d[0] for d in expected.description], expected.fetchall())
    got = rows_by_name(frame.columns, frame.collect())
    assert got[0] == want[0], f"columns {got[0]} and {want[0]}"
    assert len(got[1]) == len(want[1]), f"{len(got[1])} rows and {len(want[1])}"
    for mine, theirs in zip(got[1], want[1]):
        assert mine == theirs, f"{mine} and {theirs}"
        assert [type(v) for v in mine] == [type(v) for v in theirs], f"types of {mine} and {theirs}"
    return len(want[1])
