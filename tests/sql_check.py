"""Compare registered queries with their SQL, the way the correctness gate does."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None when rows agree, else a short description of the first difference."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN"}
    for column, kind in df.dtypes:
        if kinds.get(kind, kind) != types[column]:
            return f"type of {column}: {kind} != {types[column]}"
    got = [tuple(r) for r in df.collect()]
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    left, right = _rows(df.columns, got), _rows(names, expected)
    for a, b in zip(left, right):
        if a != b:
            for x, y in zip(a, b):
                if x != y:
                    k = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), 0)
                    return f"{a[-1][:40]}: {x[max(k-60,0):k+80]} != {y[max(k-60,0):k+80]}"
    return None
