"""Time the headline queries: ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Prints one JSON line.

Every query is built and run to the last column of the last row (the ``noop`` sink), so nothing is pruned that a
user would read. One untimed run of every query first, then the best of the timed runs: what is reported is the work
of the query, not the start of the JVM. ``cold`` holds the first runs, start-up and code generation included.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harness.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
HEADLINE = [
    "q_tag_skills", "q_silver", "q_best_per_key", "q_skill_demand", "q_seniority_share", "q_ratio_checks",
    "q_latest_per_uid", "q_upsert_by_key", "q_html_to_text", "q_description_fallback", "q_cards_b_roundtrip",
    "q_detail_b_roundtrip", "q_join_orders_left", "q_latest_event_per_user", "q_orphan_check",
]
# the table whose rows a query works through, for rows per second
INPUT = {"q_html_to_text": "pages", "q_description_fallback": "pages", "q_join_orders_left": "orders",
         "q_latest_event_per_user": "events", "q_orphan_check": "lineitem"}


def run(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold = {name: run(spark, name) for name in HEADLINE}
    warm = {name: min(run(spark, name) for _ in range(RUNS)) for name in HEADLINE}
    rows = {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet").count() for t in {"documents", *INPUT.values()}}
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": {n: round(s, 3) for n, s in warm.items()},
        "rows_per_sec": {n: round(rows[INPUT.get(n, "documents")] / s) for n, s in warm.items()},
        "cold": {n: round(s, 3) for n, s in cold.items()},
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
