"""Run registered queries beside their SQL and compare rows. Also a script: ``python -m tests.compare [sf] [name...]``."""

from __future__ import annotations

import datetime
import decimal
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(base: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{base}/{t}.parquet'")
    return con


def plain(value):
    """One Python form for equal values of either engine."""
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return repr(value)  # also tells -0.0 from 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat(timespec="microseconds")
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, (float, decimal.Decimal)):
        return type(value).__name__
    return type(value).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def types_of(columns, rows):
    types: dict[str, set[str]] = {c: set() for c in columns}
    for r in rows:
        for c, v in zip(columns, r):
            if v is not None:
                types[c].add(kind(v))
    return types


def check(spark, con, base: str, name: str, query, sql: str | None):
    """None if equal, else what differs; and the row count."""
    df = query(spark, base)
    got_raw = [tuple(r) for r in df.collect()]
    if sql is None:
        return None, len(got_raw)
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want_raw = cursor.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", len(got_raw)
    names, got = rows_of(df.columns, got_raw)
    _, want = rows_of(columns, want_raw)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}", len(got)
    if got != want:
        for g, w in zip(got, want):
            if g != w:
                return f"first difference {dict(zip(names, g))} != {dict(zip(names, w))}", len(got)
    a, b = types_of(df.columns, got_raw), types_of(columns, want_raw)
    if a != b:
        return f"types differ: { {c: (a[c], b[c]) for c in a if a[c] != b[c]} }", len(got)
    return None, len(got)


def main() -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from custodia.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    base = f"/root/testdata/sf{sf}"
    spark = local_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(base)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, query in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem, n = check(spark, con, base, name, query, oracles.get(name))
        except Exception as error:  # report and go on
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", -1
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:30s} {n:8d} rows {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{len(wanted) or len(queries)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
