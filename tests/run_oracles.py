"""Run registered queries against their DuckDB oracles at one scale.

usage: python tests/run_oracles.py [sf_dir] [name ...]
"""
import json
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from tidewater.plans import all_queries  # noqa: E402
from tidewater.plans.check import compare, duck_connection  # noqa: E402
from tidewater.session import get_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or sorted(all_queries())
spark = get_session(master="local[8]", shuffle_partitions=8)
con = duck_connection(sf)
bad = 0
for n in names:
    t = time.time()
    try:
        r = compare(spark, n, sf, con)
    except Exception as e:  # report and go on
        r = {"name": n, "error": repr(e)[:600]}
    r["sec"] = round(time.time() - t, 2)
    ok = r.get("oracle") is False or (r.get("hash_match") and r.get("cols_match")
                                      and r.get("spark_rows") == r.get("duck_rows"))
    bad += not ok
    print(("OK  " if ok else "BAD ") + json.dumps(r, default=str), flush=True)
print("bad:", bad)
