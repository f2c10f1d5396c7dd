"""python tests/check.py [sf] [name part ...]: run queries against their SQL."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

import __spark_entry__ as e
from compare import connect, differences

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
parts = sys.argv[2:]
spark = (
    SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
    .config("spark.driver.memory", "8g").getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con = connect(sf)
sql = e.oracle_sql()
bad = 0
for name, fn in e.queries().items():
    if parts and not any(p in name for p in parts):
        continue
    t = time.time()
    try:
        out = differences(con, fn(spark, sf), sql[name]) if name in sql else f"{fn(spark, sf).count()} rows, no SQL"
        ok = not out or name not in sql
    except Exception as ex:
        out, ok = f"{type(ex).__name__}: {str(ex)[:600]}", False
    bad += not ok
    print(f"{'ok ' if ok else 'BAD'} {time.time() - t:5.1f}s {name} {out}", flush=True)
print("failed:", bad)
