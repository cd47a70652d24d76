"""Time the headline queries: one warm-up, then the median of three runs.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set data and
cores. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from fieldloom.session import build_session  # noqa: E402

HEADLINE = [
    "view_survey",
    "view_support",
    "load_survey_new",
    "load_log_mark",
    "people_oos",
    "notes_donor",
    "name_guess",
    "address_standardise",
    "match_candidates",
    "match_best",
    "match_merge",
    "match_run",
    "audit_workflows",
    "audit_jobs",
    "audit_runtime",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            # the inputs are a few megabytes: keep all cores busy after a shuffle
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(4):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    result = {
        "metric": "total of query medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
