"""Benchmark: wall time of the headline queries at one scale factor.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 4),
BENCH_RUNS (timed runs per query after one warm-up, default 1; the median is kept),
BENCH_QUERIES (comma-separated subset), BENCH_EVENT_LOG (folder for Spark's event
log, to read stage and task times without the UI).
Each timing covers building the query (size checks and the rank checkpoint run
while the plan is assembled) and forcing the result with a ``noop`` write. One run
of the flagship query (BENCH_WARMUP, default main_long) warms the session first.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from catloss.plans import registry  # noqa: E402

HEADLINE = [
    "ylt_ranked_range",
    "main_long",
    "dialsup_long",
    "main_fanout",
    "event_validation",
    "wide_output",
    "ep_report",
    "input_aal_summary",
    "dimension_coverage",
    "quality_rules",
    "q_portfolio_waterfall",
]


def session(cpus: str) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="catloss-bench-")
    builder = SparkSession.builder
    event_log = os.environ.get("BENCH_EVENT_LOG")
    if event_log:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log)
    spark = (
        builder.master(f"local[{cpus}]")
        .appName("catloss-bench")
        .config("spark.sql.shuffle.partitions", str(max(int(cpus) * 2, 4)))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "6g")
        .config("spark.local.dir", scratch)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    return spark


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = registry.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = session(cpus)
    # Warm-up: one run of the flagship query (JIT, parquet footers, and the per-session
    # size checks of seed and catalogue lookups, which later queries reuse).
    timed(spark, os.environ.get("BENCH_WARMUP", "main_long"), sf_dir)
    out: dict[str, float] = {}
    for name in names:
        times = [timed(spark, name, sf_dir) for _ in range(runs)]
        out[name] = round(statistics.median(times), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total_wall",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "sf": sf,
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
