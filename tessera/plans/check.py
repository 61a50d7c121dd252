"""Local correctness check: every plan against its DuckDB oracle.

    python -m tessera.plans.check [sf_dir] [name ...]

Compares row count, column names and an order-insensitive value digest
(doubles rounded to 6 places).  Used by the tests and during development.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from tessera.sources.tables import TABLE_NAMES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    body = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return names, body


def compare(spark, sf_dir, name, plan, sql, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = plan(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    s_names, s_body = canon(sdf.columns, srows)
    d_names, d_body = canon(dcols, drows)
    ok = s_names == d_names and len(s_body) == len(d_body) and s_body == d_body
    detail = ""
    if not ok:
        if s_names != d_names:
            detail = f"columns spark={s_names} duck={d_names}"
        elif len(s_body) != len(d_body):
            detail = f"rows spark={len(s_body)} duck={len(d_body)}"
        else:
            diff = [(a, b) for a, b in zip(s_body, d_body) if a != b][:3]
            detail = f"values differ, e.g. {diff}"
    return ok, len(srows), t1 - t0, detail


def main(argv):
    sys.path.insert(0, ".")
    from tessera.plans import ORACLES, QUERIES
    from tessera.session import get_spark

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or sorted(QUERIES)
    spark = get_spark()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        if n not in ORACLES:
            df = QUERIES[n](spark, sf_dir)
            print(f"{n:32s} rows-only {df.count()}")
            continue
        try:
            ok, rows, sec, detail = compare(spark, sf_dir, n, QUERIES[n], ORACLES[n], con)
        except Exception as e:  # report and continue
            ok, rows, sec, detail = False, -1, 0.0, f"{type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{n:32s} {'OK ' if ok else 'BAD'} rows={rows:<7d} {sec:6.2f}s {detail}")
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
