"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is executed in full with a ``noop`` write (no collect to the
driver), ``$BENCH_REPEAT`` times (default 2); ``queries`` holds the fastest
run of each (this machine's timings vary by tens of percent between runs)
and ``runs`` all of them. The projection of ``events`` onto the two input
tables is timed separately as ``load`` and is not part of ``value``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

HEADLINE = (
    "attribution_r4",
    "attribution_r3",
    "attribution_r2",
    "attribution_r1",
    "series_map",
    "funnel",
    "coverage_monitor",
    "watch_time_parts",
    # The hot-key (chunked) plan on the data where one account holds about a third of all rows.
    "attribution_r4_shared_account",
)
# Timed with the others, and named once more apart: it is no part of the totals of rounds 1 and 2.
SKEW = ("attribution_r4_shared_account",)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from playtrail.plans.catalog import QUERIES, _r4_table
    from playtrail.plans.session import local_session
    from playtrail.sources.fixture import fixture_tables

    spark = local_session(cores=cpus, shuffle_partitions=max(cpus, 8))
    # Untimed warm-up on the smallest data: JVM start, JIT and code generation.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if Path(warm_dir).exists():
        QUERIES["attribution_r4"](spark, warm_dir).write.format("noop").mode("overwrite").save()
    t0 = time.time()
    clicks, videos = fixture_tables(spark, sf_dir)
    rows = {"clickstream": clicks.count(), "video_log": videos.count()}
    load = time.time() - t0

    t0 = time.time()
    if {"funnel", "coverage_monitor"} & set(names):
        _r4_table(spark, sf_dir)
    table = time.time() - t0

    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    runs = {name: [] for name in names}
    for _ in range(repeat):
        for name in names:
            t = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[name].append(round(time.time() - t, 3))
    times = {name: min(r) for name, r in runs.items()}
    skew = {name: times[name] for name in SKEW if name in times}
    spark.stop()

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "stat": "min",
                "runs": runs,
                "skew_queries": skew,
                # The reports read a table that the session has built once; its build is timed by itself.
                "report_table_sec": round(table, 3),
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "load_sec": round(load, 3),
                "warmup": warm_dir,
                "input_rows": rows,
            }
        )
    )


if __name__ == "__main__":
    main()
