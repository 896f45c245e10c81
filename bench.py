"""Seconds per headline query: the questions and rollups on the stored facts, and the fact builds.

The facts are built and written by month first, as a warehouse keeps them; that build is timed
too. Rollups are timed as refreshes and as stored reads. Questions and rollups run warm, median of three, every row computed (``noop`` sink).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from entry_queries import QUERIES
from foliomart.session import scratch_path, session
from foliomart.sources import trade
from foliomart.sources.warehouse import write_fact

HEADLINES = [
    "q1_top_editions_by_region",
    "q2_author_roi",
    "q3_channel_efficiency",
    "q4_product_type_profitability",
    "q5_monthly_trend",
    "q6_dc_ranking",
    "m1_monthly_sales_summary",
    "m2_daily_dc_performance",
    "m3_quarterly_author_profit",
    "m4_vendor_cost_analysis",
    "m5_channel_performance",
]
BUILDS = {"fact_sales": trade.sales, "fact_daily": trade.daily}


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    trade.stored_star(spark, sf_dir)
    for name, build in BUILDS.items():
        seconds[f"build_{name}"] = timed(
            lambda: write_fact(build(spark, sf_dir)[0], scratch_path(spark, f"bench-{name}"))
        )
        trade.stored_fact(spark, sf_dir, name)

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    for name in HEADLINES:
        run(name)
        seconds[name] = statistics.median(timed(lambda: run(name)) for _ in range(3))
        if name.startswith("m"):  # what a question reads once the rollup is stored
            path = scratch_path(spark, f"bench-{name}")
            QUERIES[name](spark, sf_dir).write.parquet(path)
            stored = spark.read.parquet(path)
            seconds[f"{name}_stored"] = statistics.median(
                timed(lambda: stored.write.format("noop").mode("overwrite").save()) for _ in range(3)
            )
    queries = {name: round(value, 3) for name, value in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "questions, rollup refreshes and stored rollups, plus fact builds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
