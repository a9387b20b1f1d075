"""Run all queries (or the named ones) against their twins: run_oracle.py DIRECTORY [name ...]"""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle import compare, connect  # noqa: E402
from paperloom import build_session  # noqa: E402


def main(directory, names):
    spark = build_session("oracle", "local[8]", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(directory), 0
    plans, sql = entry.queries(), entry.oracle_sql()
    for name in names or plans:
        start = time.time()
        try:
            frame = plans[name](spark, directory)
            problem = compare(frame, con, sql[name]) if name in sql else None
            note = "ok" if name in sql else f"rows {frame.count()}"
        except Exception as failure:
            problem = "".join(traceback.format_exception_only(failure))[:1200]
        took = time.time() - start
        bad += problem is not None
        print(f"{took:6.1f}s {name}: {problem or note}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
