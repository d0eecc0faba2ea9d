"""Hot-customer experiment: a third of all purchases moved onto one customer.

Runs the rollup on the fixture mapping with ``clave_persona = 0`` for every order whose
key is divisible by 3, writes Spark's event log to a scratch folder, and prints per
stage the task count, the largest task's shuffle-read records and the median. With the
ticket number in the first shuffle key and map-side combining, no stage should have one
task reading a third of the rows.

Usage: python scripts/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from edflux.plans.rollup import SwitchingAnalysis  # noqa: E402
from edflux.session import build_session  # noqa: E402
from edflux.sources.fixtures import FIXTURE_AS_OF, fixture_editions, fixture_purchases  # noqa: E402


def _events(folder):
    import zstandard

    for f in sorted(glob.glob(f"{folder}/*/events_*") + glob.glob(f"{folder}/*.zstd")):
        data = open(f, "rb").read()
        if f.endswith(".zstd"):
            data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data)).read()
        for line in data.decode().splitlines():
            yield json.loads(line)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="edflux-skew-")
    spark = build_session(
        "local[8]",
        shuffle_partitions=32,
        extra_conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": scratch,
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    purchases = fixture_purchases(spark, sf_dir).withColumn(
        "clave_persona",
        F.when((F.col("clave_detalle_compra") / 10).cast("bigint") % 3 == 0, F.lit(0).cast("bigint")).otherwise(
            F.col("clave_persona")
        ),
    )
    a = SwitchingAnalysis(purchases, fixture_editions(spark, sf_dir), FIXTURE_AS_OF)
    t0 = time.perf_counter()
    rows = a.rollup.where(F.col("clave_persona") == 0).count()
    total = a.rollup.count()
    secs = time.perf_counter() - t0
    hot = a.flagged.where(F.col("clave_persona") == 0).count()
    allp = a.flagged.count()
    spark.stop()

    stages: dict[int, list[tuple[int, float]]] = {}
    for e in _events(scratch):
        if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            m = e["Task Metrics"]
            rec = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            info = e["Task Info"]
            dur = (info["Finish Time"] - info["Launch Time"]) / 1000
            stages.setdefault(e["Stage ID"], []).append((rec, dur))
    print(f"hot customer purchases: {hot} of {allp} ({hot / max(allp, 1):.0%}); rollup rows {total}, hot rows {rows}; {secs:.1f}s")
    print("stage tasks max_shuffle_records median max_task_s")
    for sid, ts in sorted(stages.items()):
        recs = [r for r, _ in ts]
        if max(recs) == 0:
            continue
        print(f"{sid:5d} {len(ts):5d} {max(recs):12d} {int(statistics.median(recs)):8d} {max(d for _, d in ts):8.2f}")


if __name__ == "__main__":
    main()
