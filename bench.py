"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query is run to its end into a sink that keeps nothing. Stored inputs (facts, dictionaries,
landed blocks) are written before the clock starts, as they are tables in real use.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

from chainloom import build_session, catalog
from chainloom.catalog import standins
from chainloom.operators.rollup import add_rollups, relay_daily
from chainloom.plans.ingest import relay_batch

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
CATALOG = [
    "relay_daily", "grouped_aggregates", "dict_lookup",
    "merge_ranges", "range_gaps", "union_gaps", "subtract_points", "range_overlap_join",
    "handler_needs_range", "points_to_islands", "coverage_report",
    "nearest_asof", "priced_rewards", "first_wins_dedup", "record_failure",
    "decode_blocks", "rewards_responses", "rolling_rps", "latency_quantiles",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]")
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="chainloom-bench-")
    facts, providers, chains = standins.star(spark, SF_DIR)
    for name, df in (("facts", facts), ("providers", providers), ("chains", chains)):
        df.write.parquet(f"{root}/{name}")
    load = lambda name: spark.read.parquet(f"{root}/{name}")
    standins.landed_blocks(spark, SF_DIR)

    def rebuild():
        return relay_daily(load("facts"), load("providers"), load("chains"))

    rebuild().write.parquet(f"{root}/rollup")
    top = load("facts").agg(F.max("block_height")).first()[0]
    recent = F.col("block_height") > int(top * 0.99)

    jobs = {
        "rollup_full_rebuild": lambda: run(rebuild()),
        "rollup_increment_1pct": lambda: run(
            add_rollups(
                load("rollup"), relay_daily(load("facts").where(recent), load("providers"), load("chains"))
            )
        ),
        "ingest_landed_blocks": lambda: run(
            relay_batch(spark, standins.landed_blocks(spark, SF_DIR))["facts"]
        ),
    }
    for name in CATALOG:
        jobs[name] = lambda n=name: run(catalog.QUERIES[n](spark, SF_DIR))
    timings = {}
    for name, job in jobs.items():
        start = time.perf_counter()
        job()
        timings[name] = round(time.perf_counter() - start, 3)
        print(name, timings[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
