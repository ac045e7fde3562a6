"""python tests/check.py [scale] [name ...]: compare registered queries with their SQL."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import spark_rows, sql_rows  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

if __name__ == "__main__":
    folder = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[2:] or list(entry.queries())
    for name in names:
        started = time.time()
        try:
            columns, rows = spark_rows(entry.queries()[name](spark, folder))
            seconds = time.time() - started
            sql = entry.oracle_sql().get(name)
            if sql is None:
                print(f"{name}: {len(rows)} rows, no SQL, {seconds:.1f}s", rows[:2], flush=True)
                continue
            sql_columns, expected = sql_rows(folder, sql)
            if (columns, rows) == (sql_columns, expected):
                print(f"{name}: ok, {len(rows)} rows, {seconds:.1f}s", flush=True)
            else:
                odd = [(a, b) for a, b in zip(rows, expected) if a != b][:3]
                print(f"{name}: DIFFERENT {columns} {sql_columns} {len(rows)} {len(expected)} {odd}", flush=True)
        except Exception as error:
            print(f"{name}: FAILED {type(error).__name__} {str(error)[:1500]}", flush=True)
