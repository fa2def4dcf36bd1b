"""Run registered queries against their DuckDB oracles: ``python check_oracles.py [sf_dir] [names…]``."""

import json
import sys
import time

from quarry.plans.oracle import compare
from quarry.plans.registry import all_queries
from quarry.session import get_session

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(all_queries())
    spark = get_session("local[8]")
    bad = 0
    for n in names:
        t = time.time()
        try:
            r = compare(spark, n, sf_dir)
        except Exception as e:  # report and go on
            r = {"name": n, "status": "ERROR", "error": repr(e)[:600]}
        r["sec"] = round(time.time() - t, 2)
        bad += r["status"] not in ("ok", "rows-only")
        print(json.dumps(r, ensure_ascii=False, default=str), flush=True)
    print(f"# {len(names) - bad}/{len(names)} fine", flush=True)
