"""Run a registered query and its reference SQL on the same tables and compare them."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, decimal.Decimal):
        raise AssertionError("decimal in a result: cast it, the two engines print it differently")
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)
    return f"{type(v).__name__}:{v}"


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(got), None
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(want_names), (name, sorted(df.columns), sorted(want_names))
    want = _rows(want_names, cur.fetchall())
    if got != want:
        g, w = set(got), set(want)
        raise AssertionError(
            f"{name}: {len(got)} rows, want {len(want)}; columns {sorted(df.columns)}; "
            f"only spark {sorted(g - w)[:3]}; only sql {sorted(w - g)[:3]}"
        )
    return len(got), True


def main(argv):
    """python tests/oracle.py <sf_dir> [query ...]"""
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from cubeweave.runtime import local_session

    sf_dir, wanted = argv[0], argv[1:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        began = time.time()
        try:
            n, ok = compare(spark, con, name, fn, oracles.get(name), sf_dir)
            note = "ok" if ok else "rows only"
            print(f"{name:28s} {n:7d} rows {time.time() - began:6.2f}s {note}", flush=True)
            if n == 0:
                print(f"   EMPTY {name}", flush=True)
        except Exception as exc:  # noqa: BLE001
            bad += 1
            print(f"{name:28s} FAIL {type(exc).__name__}: {str(exc)[:1500]}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
