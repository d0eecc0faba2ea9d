"""Write the formatted physical plans of the headline queries to docs/plans/.

Usage: python scripts/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from edflux.plans.queries import QUERIES  # noqa: E402
from edflux.session import build_session  # noqa: E402

HEADLINE = ["edition_windows", "own_history", "other_purchases", "rollup_full", "migration_flow", "quality_counters"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[4]", shuffle_partitions=4)
    spark.sparkContext.setLogLevel("ERROR")
    out_dir = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    for name in HEADLINE:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, sf_dir).explain("formatted")
        text = buf.getvalue()
        # Keep the tree and the scan details; the per-node argument dump is long.
        tree, _, details = text.partition("\n\n\n")
        scans = [b for b in details.split("\n\n") if "Scan parquet" in b.split("\n")[0]]
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as f:
            f.write(tree.rstrip() + "\n\n" + "\n\n".join(s.strip() for s in scans) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
