"""Run every query against its SQL: ``python tests/check_all.py [folder] [name ...]``."""

import pathlib
import sys
import time

sys.path[:0] = [str(pathlib.Path(__file__).parent), str(pathlib.Path(__file__).parents[1])]

from compare import connect, differences  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            result = query(spark, folder)
            sql = entry.oracle_sql().get(name)
            problem = differences(result, con, sql) if sql else (
                None if result.count() else "no rows")
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s "
              f"{problem or ''}", flush=True)
    print(f"{failed} failed")
