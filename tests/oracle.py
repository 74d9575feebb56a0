"""Compare registered queries with their SQL, value by value."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime) and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, (float, Decimal)):
        return "float"
    if isinstance(value, date):
        return "date"
    return type(value).__name__


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], [tuple(plain(r[i]) for i in order) for r in data]


def compare(name, build, sql, spark, folder, con):
    """None when equal, else a text that says what differs."""
    df = build(spark, folder)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    types = dict(df.dtypes)
    found = {d[0]: str(d[1]).upper() for d in result.description}
    names = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}
    odd = [f"{c}: {types[c]} / {found[c]}" for c in got_columns if names.get(types[c]) != found[c]]
    if odd:
        print(f"   types of {name}: {odd}")
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    text = lambda r: tuple(repr(v) for v in r)
    left, right = sorted(got, key=text), sorted(want, key=text)
    for i, c in enumerate(got_columns):
        a, b = {kind(r[i]) for r in left if r[i] is not None}, {kind(r[i]) for r in right if r[i] is not None}
        if a and b and a != b:
            return f"column {c}: {a} != {b}"
    if left != right:
        a, b = set(left), set(right)
        return f"values of {got_columns}: only Spark {list(a - b)[:2]}, only SQL {list(b - a)[:2]} ({len(a - b)} rows)"
    return None


def main(folder: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from shelfmark.session import local_session

    spark, con = local_session(), connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, build in queries.items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(name, build, oracles[name], spark, folder, con)
                state = "ok" if problem is None else "DIFF " + problem[:700]
            else:
                state = f"rows only: {len(build(spark, folder).collect())}"
        except Exception as error:
            state = "ERROR " + str(error)[:700]
        bad += state.startswith(("DIFF", "ERROR"))
        print(f"{name:32s} {time.time() - start:6.2f}s {state}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
