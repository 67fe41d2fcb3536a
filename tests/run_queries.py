"""python tests/run_queries.py [sf] [name ...]: side-by-side check with timings."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry  # noqa: E402
from boxloom.cluster import local_session  # noqa: E402
from side_by_side import compare, connect  # noqa: E402

folder = sys.argv[1] if "/" in sys.argv[1] else f"/root/testdata/sf{sys.argv[1]}"
wanted = sys.argv[2:]
spark = local_session(8, 8)
spark.sparkContext.setLogLevel("ERROR")
con = connect(folder)
queries, oracles = entry.queries(), entry.oracle_sql()
bad = 0
for name in wanted or queries:
    start = time.time()
    try:
        frame = queries[name](spark, folder)
        if name in oracles:
            n, problems = compare(frame, con, oracles[name])
        else:
            n, problems = frame.count(), []
    except Exception as error:  # report and go on
        n, problems = -1, [f"{type(error).__name__}: {str(error)[:400].replace("\n", " ")}"]
    bad += bool(problems)
    print(f"{'BAD' if problems else 'ok ' if name in oracles else 'run'} {name:24s} {n:8d} rows {time.time() - start:6.2f}s",
          *problems, flush=True)
print("bad:", bad, "of", len(wanted or queries))
