"""Run the whole catalog against its SQL: ``python tests/check_all.py [sf_dir] [key ...]``."""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from pyspark.sql import SparkSession  # noqa: E402

from compare import connect, differences  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402
from crawlframe.session import configure  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    # CHECK_PLAIN=1: a session without any of our settings.
    spark = (builder if os.environ.get("CHECK_PLAIN") else configure(builder, 8)).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf), oracle_sql(), 0
    for name, run in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in sql:
                n, diff = differences(run(spark, sf), con, sql[name])
            else:
                n, diff = run(spark, sf).count(), ""
        except Exception as e:  # noqa: BLE001
            n, diff = -1, f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(diff)
        print(f"{'ok  ' if not diff else 'FAIL'} {name} rows={n} {time.time() - start:.2f}s {diff}", flush=True)
    print("failed", failed)


if __name__ == "__main__":
    main()
