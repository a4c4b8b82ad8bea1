"""Compare a Spark result with a DuckDB result, ignoring the order of rows and columns."""

import glob
import math
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isfinite(value):
        return repr(value)
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows),
        key=lambda row: [(v is not None, str(v)) for v in row],
    )


def assert_same(result, connection, sql: str) -> int:
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(names)
    want = _sorted(names, expected.fetchall())
    got = _sorted(result.columns, [tuple(row) for row in result.collect()])
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == b
    return len(got)
