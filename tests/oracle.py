"""Side-by-side comparison of a registered query with its SQL check."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(row[i] for i in order) for row in rows]
    key = [
        tuple((v is not None, f"{v:.4f}" if isinstance(v, float) else str(v)) for v in row) for row in plain
    ]
    return sorted(names), [row for _, row in sorted(zip(key, plain), key=lambda pair: pair[0])]


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b and type(a) is type(b)


def plan(df) -> str:
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def differences(df, connection, sql: str) -> list[str]:
    """Empty when columns, types and all values are equal."""
    result_types = connection.execute(f"DESCRIBE {sql}").fetchall()
    result = connection.execute(sql)
    names, expected = _rows([d[0] for d in result.description], result.fetchall())
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if names != got_names:
        return [f"columns {got_names} against {names}"]
    types = {name: SQL_TYPES.get(kind, kind) for name, kind in df.dtypes}
    described = {d[0]: str(d[1]).upper() for d in result_types}
    if types != described:
        return [f"types {types} against {described}"]
    if len(got) != len(expected):
        return [f"{len(got)} rows against {len(expected)}"]
    return [
        f"{a} against {b}" for a, b in zip(got, expected) if not all(_same(x, y) for x, y in zip(a, b))
    ]
