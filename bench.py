"""Times the queries and prints one line of JSON.

BENCH_SF_DIR names the folder of the test tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from workload import ALL

# The table whose rows a headline query works through.
HEADLINES = {
    "apply_partial": "events",
    "apply_full": "events",
    "apply_key_injection": "events",
    "snapshot_records": "orders",
    "capture_diff": "customer",
    "cdc_records": "events",
    "parse_datetime": "events",
    "stream_tail": "events",
    "stream_replay": "events",
}
RUNS = 3


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-shared-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    chosen = sys.argv[1:] or list(ALL)
    seconds = {}
    for name in chosen:
        runs = []
        for _ in range(RUNS):
            begin = time.perf_counter()
            ALL[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
        seconds[name] = round(median(runs), 3)
    counts = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in set(HEADLINES.values())}
    rates = {n: round(counts[t] / seconds[n]) for n, t in HEADLINES.items() if n in seconds}
    print(
        json.dumps(
            {
                "metric": "total time of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
