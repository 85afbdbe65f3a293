"""Headline-query benchmark.

Runs the headline queries on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and prints one JSON line.  Each query is executed
to completion through the ``noop`` sink (every row computed, nothing
collected); one warm-up run, then the median of ``$BENCH_REPEATS`` (3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sluice.plans import load_all  # noqa: E402
from sluice.session import build_session  # noqa: E402

HEADLINE = [
    "a01_word_count_batch",
    "w03_win_sliding_event",
    "w05_win_session_event",
    "tk02_topn_window_incremental",
    "j02_join_interval",
    "t05_late_side_output_late",
    "st04_state_reducing_sum",
    "st04_state_reducing_sum_tws",
    "a02_word_count_stream",
    "j03_join_interval_late_joined",
    "j07_broadcast_rule",
    "st06_state_ttl",
    "st09_timer_event_time",
    "w13_win_process",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        extra={"spark.driver.memory": "16g"},
    )
    reg = load_all()
    times: dict[str, float] = {}
    for name in names:
        fn = reg[name][0]
        runs = []
        for i in range(repeats + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # first run warms the JVM / caches
                runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "cpus": int(cpus),
                "shuffle_partitions": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
