"""Run registered queries against DuckDB on the same Parquet files.

``python tests/oracle.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(0.0 if v == 0 else v)
    return str(v)


def _family(dtype: str) -> str:
    d = dtype.lower()
    for names, family in [
        (("tinyint", "smallint", "int", "bigint", "integer", "hugeint"), "int"),
        (("double", "float"), "double"),
        (("string", "varchar"), "string"),
        (("timestamp_ntz", "timestamp"), "timestamp"),
    ]:
        if d in names:
            return family
    return d.split("(")[0]


def compare(spark_df, con, sql: str) -> str | None:
    """None if names, type families, row counts and values agree; else what differs."""
    con.execute(sql)
    names = [d[0] for d in con.description]
    kinds = dict(zip(names, [str(d[1]) for d in con.description]))
    want = con.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    types = dict(spark_df.dtypes)
    for n in names:
        if _family(types[n]) != _family(kinds[n]):
            return f"type of {n}: {types[n]} against {kinds[n]}"
    order = sorted(names)
    got = sorted(tuple(_norm(r[c]) for c in order) for r in spark_df.collect())
    idx = [names.index(c) for c in order]
    exp = sorted(tuple(_norm(r[i]) for i in idx) for r in want)
    if len(got) != len(exp):
        return f"{len(got)} rows against {len(exp)}"
    for a, b in zip(got, exp):
        if a != b:
            return f"{order}: {a} against {b}"
    if not got:
        return "both sides are empty"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from siltbed.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session()
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in only or queries:
        start = time.perf_counter()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                verdict = compare(df, con, oracles[name])
            else:
                verdict = None if df.collect() else "no rows"
        except Exception as exc:
            verdict = "".join(traceback.format_exception_only(exc))[:1500]
        took = time.perf_counter() - start
        bad += verdict is not None
        kind = "sql " if name in oracles else "rows"
        print(f"{'ok  ' if verdict is None else 'BAD '} {kind} {took:6.2f}s {name} {verdict or ''}", flush=True)
    print(f"{len(only or queries)} queries, {bad} bad")
    spark.stop()
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
