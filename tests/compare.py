"""Runs queries next to their SQL: ``python tests/compare.py [--sf DIR] NAME...``."""

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402
from tessera.session import local_session  # noqa: E402


def canon(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 9))
    return str(v)


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in data)


def compare(spark, name, sf):
    df = entry.queries()[name](spark, sf)
    t = time.time()
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - t
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"{name}: {len(got)} rows, {took:.1f} s, no SQL", True, got
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for p in glob.glob(f"{sf}/*.parquet"):
        src = p if os.path.isfile(p) else f"{p}/*.parquet"
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{src}')")
    rel = con.sql(sql)
    want = rows(rel.columns, rel.fetchall())
    same = got == want and sorted(df.columns) == sorted(rel.columns)
    note = ""
    if not same:
        a, b = [x for x in got if x not in set(want)], [x for x in want if x not in set(got)]
        note = f" cols {sorted(df.columns)} {sorted(rel.columns)} only ours {len(a)} {a[:4]} only SQL {len(b)} {b[:4]}"
    return f"{name}: {len(got)} rows, {took:.1f} s, {'same' if same else 'DIFFERENT'}{note}", same, got


if __name__ == "__main__":
    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        sf, args = args[1], args[2:]
    spark = local_session(8, 8)
    spark.sparkContext.setLogLevel("ERROR")
    names = args or list(entry.queries())
    ok = True
    for n in names:
        try:
            text, same, _ = compare(spark, n, sf)
        except Exception as e:
            text, same = f"{n}: ERROR {type(e).__name__} {str(e)[:1500]}", False
        ok &= same
        print(text, flush=True)
    os._exit(0 if ok else 1)
