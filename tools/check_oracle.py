"""Run registered queries against their DuckDB oracle and print results.

usage: python tools/check_oracle.py [sf_dir] [name ...]
"""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import json
import time

from weekwise.oracle.compare import compare, duckdb_with_views
from weekwise.registry import oracle_sql, queries
from weekwise.session import build_session

args = sys.argv[1:]
sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
spark = build_session()
con = duckdb_with_views(sf_dir)
qs, sqls = queries(), oracle_sql()
names = args or list(qs)
bad = 0
for name in names:
    t = time.time()
    try:
        if name in sqls:
            r = compare(qs[name](spark, sf_dir), con, sqls[name])
        else:
            r = {"rows_spark": qs[name](spark, sf_dir).count(), "ok": None}
    except Exception as e:  # report and continue
        r = {"ok": False, "error": repr(e)[:800]}
    r["sec"] = round(time.time() - t, 2)
    bad += r.get("ok") is False
    print(name, json.dumps(r, default=str), flush=True)
print("FAILED" if bad else "ALL OK", bad)
