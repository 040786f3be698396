"""Time every registered query once and print one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma-separated names) override the defaults.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from costlake.checks.queries import REGISTERED  # noqa: E402
from costlake.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(REGISTERED)
    spark = build_session(
        "costlake-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # Files of a local disk are listed faster by the driver than by a job.
            "spark.sql.sources.parallelPartitionDiscovery.threshold": "1000",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()

    seconds = {}
    for name in wanted:
        started = time.perf_counter()
        REGISTERED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)

    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    scale = re.search(r"sf([0-9.]+)$", sf_dir)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "stream_rows_per_sec": {
            name: round(events / taken) for name, taken in seconds.items() if name.startswith("stream_")
        },
        "sf": float(scale.group(1)) if scale else None,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
