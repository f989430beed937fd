"""Compare every query with its SQL and print one line each: python tests/check_all.py [sf] [name ...]."""

import pathlib
import sys
import time

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

import __spark_entry__ as e  # noqa: E402
import compare  # noqa: E402
from sangam.session import local_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
names = sys.argv[2:] or list(e.queries())
d = f"/root/testdata/sf{sf}"
spark = local_session(8)
spark.sparkContext.setLogLevel("ERROR")
con = compare.connect(d)
bad = 0
for name in names:
    t = time.time()
    try:
        df = e.queries()[name](spark, d)
        mine = compare.spark_rows(df)
        took = time.time() - t
        sql = e.oracle_sql().get(name)
        if sql is None:
            print(f"{name}: {len(mine[1])} rows, no SQL, {took:.1f}s", flush=True)
            continue
        t = time.time()
        theirs = compare.duck_rows(con, sql)
        same = mine == theirs
        bad += not same
        print(f"{name}: {'ok' if same else 'DIFF'} {len(mine[1])}/{len(theirs[1])} spark {took:.1f}s duckdb {time.time() - t:.1f}s", flush=True)
        types = compare.duck_types(con, sql)
        print("    ", {c: (t, types.get(c)) for c, t in df.dtypes})
        if not same:
            print("   columns", mine[0], theirs[0])
            for a, b in [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b][:3]:
                print("   spark ", str(a)[:300], "\n   duckdb", str(b)[:300])
    except Exception as err:  # noqa: BLE001
        bad += 1
        print(f"{name}: ERROR {str(err)[:600]}", flush=True)
print("bad:", bad)
