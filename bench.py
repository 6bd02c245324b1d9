"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Every query runs once to warm up and is then timed twice over all its rows and
columns (the noop sink consumes the result); the better time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyspark  # noqa: E402

from rowferry.queries import QUERIES  # noqa: E402
from rowferry.session import get_session  # noqa: E402

HEADLINE = (
    "clean_fact",
    "clean_orders_star",
    "fk_resolve_multi",
    "join_left_star",
    "dedupe_last",
    "merge_upsert",
    "merge_composite_key",
    "load_skip_existing",
    "reconcile_keys",
    "page_cover_check",
    "load_table",
    "stream_upsert",
)

# The table whose rows a query works through, for rows per second.
DRIVING = {"clean_fact": "lineitem", "join_left_star": "lineitem", "dedupe_last": "lineitem", "merge_composite_key": "lineitem"}


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = get_session(
        "rowferry-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, rates = {}, {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        seconds[name] = round(min(run(spark, name, sf_dir) for _ in range(2)), 4)
        rows = spark.read.parquet(f"{sf_dir}/{DRIVING.get(name, 'orders')}.parquet").count()
        rates[name] = round(rows / seconds[name])
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "sf": float(os.path.basename(sf_dir).removeprefix("sf")) if "sf" in os.path.basename(sf_dir) else sf_dir,
                "cpus": int(cpus),
                "spark": pyspark.__version__,
            }
        )
    )


if __name__ == "__main__":
    main()
