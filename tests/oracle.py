"""Compare registered queries with their DuckDB twins.

``python -m tests.oracle [key-prefix ...]`` prints one line per key.
"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def duck(sf_dir: str = SF_DIR) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    flat = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(flat, key=lambda r: [(x is None, str(type(x)), x if x is not None else 0) for x in r])


def compare(spark, key: str, fn, sql: str | None, con, sf_dir: str = SF_DIR) -> str | None:
    """None when equal, else a description of the first difference."""
    df = fn(spark, sf_dir)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = normal(cur.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if not want and not got:
        return "oracle is empty"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; only spark {[r for r in got if r not in set(want)][:2]}; only duck {[r for r in want if r not in set(got)][:2]}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            bad = sum(a != b for a, b in zip(got, want))
            return f"{bad} of {len(want)} rows differ, e.g. {sorted(df.columns)}: {g} != {w}"
    return None


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from millrace.session import local_session

    spark = local_session()
    if os.environ.get("FORCE_SPLIT"):
        spark.conf.set("spark.millrace.split.smallBytes", "0")
    con = duck()
    sqls = entry.oracle_sql()
    wanted = sys.argv[1:]
    bad = 0
    for key, fn in entry.queries().items():
        if wanted and not any(key.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            problem = compare(spark, key, fn, sqls.get(key), con)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        took = time.time() - start
        if problem or took > 4 or not os.environ.get("QUIET"):
            print(f"{'BAD' if problem else 'ok ' if key in sqls else 'run'} {key} {took:.1f}s {problem or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
