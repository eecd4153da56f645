"""Run registered queries and their check SQL side by side.

usage: python tools/check.py [--sf 0.01] [name or module prefix ...]
"""

from __future__ import annotations

import argparse
import importlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from evidara.plans import load_all  # noqa: E402
from evidara.plans.registry import ORACLES, QUERIES  # noqa: E402
from evidara.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents labels "
          "benchmark pages conversations embeddings").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--module", default=None)
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    if a.module:
        for m in a.module.split(","):
            importlib.import_module(f"evidara.plans.{m}")
    else:
        load_all()
    sf_dir = f"/root/testdata/sf{a.sf}"
    spark = local_session()
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    names = [n for n in QUERIES if not a.names or any(n.startswith(p) for p in a.names)]
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            df = QUERIES[n](spark, sf_dir)
            got = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR {n}: {str(e)[:1500]}", flush=True)
            continue
        t1 = time.time()
        if n not in ORACLES:
            print(f"rows  {n}: {len(got)} rows {t1 - t0:.1f}s (no SQL) {got[:1]}"[:300], flush=True)
            continue
        try:
            rel = con.execute(ORACLES[n])
            cols = [d[0] for d in rel.description]
            want = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"SQLERR {n}: {str(e)[:1500]}", flush=True)
            continue
        t2 = time.time()
        g, w = rows_of(df.columns, got), rows_of(cols, want)
        if sorted(df.columns) != sorted(cols):
            bad += 1
            print(f"COLS  {n}: {sorted(df.columns)} != {sorted(cols)}", flush=True)
        elif g != w:
            bad += 1
            diff = [(x, y) for x, y in zip(g, w) if x != y][:3]
            print(f"DIFF  {n}: {len(g)} vs {len(w)} rows; cols {sorted(cols)}\n   {diff}"[:1500], flush=True)
        else:
            flag = " EMPTY" if not g else ""
            print(f"ok    {n}: {len(g)} rows {t1 - t0:.1f}s sql {t2 - t1:.1f}s{flag}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
