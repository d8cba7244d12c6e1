"""``python -m checks.run [sf_dir] [name-part ...]``: compare queries with their oracles."""

from __future__ import annotations

import os
import sys
import time

from pyspark.sql import SparkSession

from checks import catalog, compare
from periodbook.session import configure


def session() -> SparkSession:
    spark = (
        configure(SparkSession.builder)
        .master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark, con = session(), compare.connect(sf_dir)
    oracle, bad = catalog.oracle_sql(), []
    for name, run in catalog.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracle:
                problems = compare.differences(df, con, oracle[name])
            else:
                problems = [] if df.count() else ["no rows"]
            rows = con.execute(f"SELECT count(*) FROM ({oracle[name]}) q").fetchone()[0] if name in oracle else -1
        except Exception as e:  # report and go on with the next query
            problems, rows = [f"{type(e).__name__}: {str(e)[:700]}"], 0
        state = "ok" if not problems else "DIFF"
        print(f"{state:5} {name} rows={rows} {time.time() - start:.1f}s", flush=True)
        for p in problems:
            print("      ", p, flush=True)
        if problems:
            bad.append(name)
    print(f"{len(bad)} with differences: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
