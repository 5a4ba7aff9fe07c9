"""Run registered queries against their SQL twins on the same parquet files.

Usage: python tests/compare.py [--large] <sf_dir> [name-prefix ...]

``--large`` plans every input as if it were too large for one task or a broadcast.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _cell(v):
    if v is None:
        return "\0"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, int):
        return str(v)
    return str(v)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df, con, sql) -> str | None:
    """None when equal, else a short description of the difference."""
    names, got = normalise(df.columns, [tuple(row) for row in df.collect()])
    result = con.sql(sql)
    expected_names, expected = normalise(result.columns, result.fetchall())
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    wrong = [(g, e) for g, e in zip(got, expected) if g != e]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, e.g. {wrong[0][0]} != {wrong[0][1]}"
    kinds = dict(zip(result.columns, map(str, result.types)))
    spark_kinds = dict(df.dtypes)
    numeric = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    odd = [
        (c, spark_kinds[c], kinds[c])
        for c in names
        if spark_kinds[c] in numeric and kinds[c] != numeric[spark_kinds[c]]
    ]
    return f"types {odd}" if odd else None


def main() -> int:
    from tests.session import LARGE, build
    import __spark_entry__ as entry

    args = sys.argv[1:]
    large = "--large" in args
    sf, *prefixes = [a for a in args if a != "--large"]
    spark = build(**(LARGE if large else {}))
    con = connect(sf)
    failures = 0
    for name, fn in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            sql = entry.oracle_sql().get(name)
            problem = compare(df, con, sql) if sql else None
            note = "" if sql else f"(rows only: {df.count()})"
        except Exception as exc:  # report every query
            problem, note = f"{type(exc).__name__}: {str(exc)[:600]}", ""
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {time.time() - start:6.2f}s {note} {problem or ''}", flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(bool(main()))
