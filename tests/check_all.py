"""``python tests/check_all.py [sf_dir] [key ...]``: run queries, compare, print times."""

from __future__ import annotations

import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from compare import connect, difference  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def main(sf_dir: str = "/root/testdata/sf0.001", *keys: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for key, query in queries().items():
        if keys and key not in keys:
            continue
        began = time.time()
        try:
            if key in sql:
                verdict = difference(query(spark, sf_dir), con, sql[key]) or "ok"
            else:
                verdict = f"rows only: {query(spark, sf_dir).count()}"
        except Exception as error:  # report and go on with the next query
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += not verdict.startswith(("ok", "rows only"))
        print(f"{key:32s} {time.time() - began:6.1f}s  {verdict}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
