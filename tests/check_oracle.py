"""Runs queries against their SQL from the command line: check_oracle.py [sf_dir] [name ...]."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            if sql is None:
                problems = [] if run(spark, sf_dir).count() >= 0 else ["no rows"]
                print(f"ROWS {name} {time.time() - started:.2f}s")
                continue
            problems = compare(run(spark, sf_dir), connection, sql)
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        print("OK  " if not problems else "FAIL", name, f"{time.time() - started:.2f}s", flush=True)
        for p in problems:
            print("    ", str(p)[:1500])
    print("failed:", bad)
