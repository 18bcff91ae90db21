"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Each query's whole result is computed (and discarded);
its time includes planning and, for streams and archives, what they write.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stoplens.session import build_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "decode_passages",
    "publish_keyed",
    "snapshot_explode",
    "dedup_observations",
    "batch_line_stats",
    "route_enrich",
    "window_stats",
    "window_stats_dedup",
    "change_events",
    "contract_violations",
    "serving_upsert",
    "serving_latest",
    "window_stats_stream",
    "window_stats_append",
    "window_stats_update",
    "change_events_stream",
]


def run(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "stoplens-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        conf={"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("batch_line_stats", "change_events_stream"):  # start the JVM's and Python's workers
        run(spark, name, sf_dir)
    seconds = {name: round(min(run(spark, name, sf_dir) for _ in range(2)), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
