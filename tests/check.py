"""python -m tests.check [sf] [query ...]: compare registered queries with their SQL."""

import sys
import time
import traceback

import catalog
from gridloom.session import build_session
from tests.compare import compare, connect

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    only = sys.argv[2:]
    if only and only[0].startswith("@"):
        catalog.MODULES = tuple(only[0][1:].split(","))
        only = []
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, q in catalog.load().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            ok, note = compare(spark, con, q, sf_dir)
        except Exception as e:
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
            if only:
                traceback.print_exc()
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.2f}s {note[:900]}", flush=True)
    print("failures:", bad)
