"""Runs registered queries on Spark and their SQL on DuckDB and compares the rows.

python tests/check.py [sf folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names, types and rows are equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} <> {sorted(names)}"
    for name, dtype in df.dtypes:
        want = _TYPES.get(dtype)
        if want and want != types[name]:
            return f"type of {name}: {dtype} <> {types[name]}"
    expected = rows_of(names, cursor.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(expected):
        return f"rows {len(got)} <> {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            return f"first difference:\n   spark  {a}\n   sql    {b}"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from sedimenta.session import build_session

    folder = argv[0] if argv else "/root/testdata/sf0.001"
    spark = build_session(master="local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con, failures = connect(folder), 0
    oracle = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            if name in oracle:
                problem = compare(fn(spark, folder), con, oracle[name])
            else:
                problem = None if fn(spark, folder).collect() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:32s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
