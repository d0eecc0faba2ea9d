"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all cores),
BENCH_REPEAT (default 3; the median is reported).

Every query runs to completion through the ``noop`` sink (full execution, nothing
collected to the driver). Plan-time size checks on edition-sized tables are included.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from edflux.plans.queries import QUERIES  # noqa: E402
from edflux.session import build_session  # noqa: E402

HEADLINE = ["edition_windows", "own_history", "other_purchases", "rollup_full", "migration_flow"]


def _sf(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    scratch = tempfile.mkdtemp(prefix="edflux-bench-")
    spark = build_session(
        f"local[{cpus}]",
        app_name="edflux-bench",
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
        extra_conf={
            "spark.driver.memory": "8g",
            "spark.local.dir": scratch,
            "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Warm the JVM and the file listings on the heaviest query.
    QUERIES["rollup_full"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    runs: dict[str, list[dict[str, float]]] = {}
    for name in HEADLINE:
        runs[name] = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            df = QUERIES[name](spark, sf_dir)
            t1 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            runs[name].append({"build": round(t1 - t0, 3), "run": round(time.perf_counter() - t1, 3)})
        timings[name] = round(statistics.median(r["build"] + r["run"] for r in runs[name]), 3)
    # Output sizes, outside the timed runs: the results are whole (no caps or samples).
    rows = {name: QUERIES[name](spark, sf_dir).count() for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total_sec",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": _sf(sf_dir),
                "cpus": cpus,
                "repeat": repeat,
                "rows": rows,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
