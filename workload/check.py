"""Run registered queries beside their SQL and compare rows: python -m workload.check [sf dir] [name ...]"""
from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

from panelkit.session import local_session
from workload import load

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.6g}" if abs(v) >= 1e6 else f"{round(v, 6) + 0.0:.6f}"
    if isinstance(v, int):
        return f"{v:d}"
    return str(v)


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    queries, oracle = load()
    names = args[1:] or list(queries)
    names = [n for n in queries if any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in names)]
    spark = local_session("panelkit-check")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            df = queries[n](spark, sf)
            rows = df.collect()
        except Exception as e:
            bad += 1
            print(f"ERROR {n}: {str(e)[:400]}")
            continue
        took = time.time() - t0
        if n not in oracle:
            print(f"rows  {n}: {len(rows)} rows, {took:.1f}s")
            continue
        try:
            cur = con.execute(oracle[n])
            cols = [d[0] for d in cur.description]
            types = {d[0]: str(d[1]) for d in cur.description}
            theirs = cur.fetchall()
        except Exception as e:
            bad += 1
            print(f"SQLERR {n}: {str(e)[:600]}")
            continue
        if sorted(cols) != sorted(df.columns):
            bad += 1
            print(f"COLS  {n}: spark {sorted(df.columns)} sql {sorted(cols)}")
            continue
        order = sorted(cols)
        kinds = {c: t.split("(")[0] for c, t in df.dtypes}
        loose = [f"{c}:{kinds[c]}/{types[c]}" for c in order if (kinds[c], types[c]) not in PAIRS]
        a = Counter(tuple(norm(r[c]) for c in order) for r in rows)
        ix = [cols.index(c) for c in order]
        b = Counter(tuple(norm(r[i]) for i in ix) for r in theirs)
        if a == b:
            print(f"ok    {n}: {len(rows)} rows, {took:.1f}s" + (f"  types {loose}" if loose else "") + ("  EMPTY" if not rows else ""))
        else:
            bad += 1
            print(f"DIFF  {n}: spark {len(rows)} sql {len(theirs)}; columns {order}")
            for r in list((a - b))[:3]:
                print("   only spark", r)
            for r in list((b - a))[:3]:
                print("   only sql  ", r)
    print(f"{len(names)} queries, {bad} bad")


PAIRS = {("string", "VARCHAR"), ("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"), ("boolean", "BOOLEAN")}

if __name__ == "__main__":
    main()
