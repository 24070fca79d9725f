"""Run all registered queries against their SQL: ``python -m tests.check_all [sf_dir] [name ...]``."""

import sys
import time

import __spark_entry__ as spark_entry
from tests.oracle_check import compare, connect
from tickloom.session import build_session


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session(master="local[8]", conf={
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sql = spark_entry.oracle_sql()
    con = connect(sf_dir)
    failed = 0
    for name, query in spark_entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            frame = query(spark, sf_dir)
            problem = compare(con, frame, sql[name]) if name in sql else f"(no SQL) {frame.count()} rows"
        except Exception as error:  # report every query, then fail
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None and not problem.startswith("(no SQL)")
        print(f"{name:26s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
