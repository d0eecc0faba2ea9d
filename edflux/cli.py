"""Command-line jobs (``spark-submit -m edflux.cli ...`` or ``python -m edflux.cli ...``).

Subcommands, one per pipeline:

- ``rollup``        purchases + editions -> rollup (optionally also the recurrent subset)
- ``recurrent``     stored rollup -> rows with at least N earlier editions
- ``flow``          stored rollup + editions -> origin-to-destination flow
- ``single-window`` purchases + editions -> one row per (customer, type), latest edition

Every input takes ``--*-format parquet|csv|table``; every output is replaced
(``overwrite``) and can be written as parquet, CSV (JSON lists as text) or a table.
"""

from __future__ import annotations

import argparse
import sys

from edflux.constants import CLOSING_DAYS, LOOKBACK_DAYS, MIN_EDITIONS, WINDOW_DAYS
from edflux.operators.flow import migration_flow
from edflux.operators.quality import JobCounters
from edflux.plans.rollup import SwitchingAnalysis, recurrent, rollup_single_window
from edflux.session import build_session
from edflux.sources.io import FORMATS, read_editions, read_purchases, read_rollup
from edflux.sources.io import write as _write


def _io(p: argparse.ArgumentParser, name: str, out: bool = False) -> None:
    p.add_argument(f"--{name}", required=not out or name == "out")
    p.add_argument(f"--{name}-format", default="parquet", choices=FORMATS)


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="edflux")
    ap.add_argument("--master", default=None, help="only for local runs; spark-submit sets it otherwise")
    ap.add_argument(
        "--shuffle-partitions",
        type=int,
        default=None,
        help="initial shuffle partitions (size so a ticket-level partition is ~128-256 MB; AQE coalesces)",
    )
    ap.add_argument("--explain", action="store_true", help="print each output's formatted physical plan first")
    sub = ap.add_subparsers(dest="cmd", required=True)

    r = sub.add_parser("rollup", help="multi-window rollup")
    _io(r, "purchases")
    _io(r, "editions")
    _io(r, "out", out=True)
    r.add_argument("--as-of", required=True, help="reference instant, e.g. '2025-10-24 00:00:00'")
    r.add_argument("--lookback-days", type=int, default=LOOKBACK_DAYS)
    r.add_argument("--window-days", type=int, default=WINDOW_DAYS)
    r.add_argument("--closing-days", type=int, default=CLOSING_DAYS)
    r.add_argument("--strict", action="store_true", help="fail on editions without key, type or number")
    r.add_argument("--checkpoint", action="store_true", help="cut lineage at the pair level")
    r.add_argument("--recurrent-out", help="also write rows with >= --min-editions earlier editions")
    r.add_argument("--recurrent-out-format", default="parquet", choices=FORMATS)
    r.add_argument("--min-editions", type=int, default=MIN_EDITIONS)
    r.add_argument("--metrics-out", help="also write the quality counters, gathered by the same job (reads all purchases)")
    r.add_argument("--metrics-out-format", default="parquet", choices=FORMATS)
    r.add_argument("--partition-by", default="", help="comma-separated output partition columns, e.g. tipo_producto")

    c = sub.add_parser("recurrent", help="filter a stored rollup")
    _io(c, "rollup")
    _io(c, "out", out=True)
    c.add_argument("--min-editions", type=int, default=MIN_EDITIONS)

    f = sub.add_parser("flow", help="origin-to-destination flow of customers lost in the closing week")
    _io(f, "rollup")
    _io(f, "editions")
    _io(f, "out", out=True)

    s = sub.add_parser("single-window", help="one row per (customer, type) against the latest edition")
    _io(s, "purchases")
    _io(s, "editions")
    _io(s, "out", out=True)
    s.add_argument("--closing-days", type=int, default=CLOSING_DAYS)
    return ap


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)

    def write(df, location, fmt, **options):  # noqa: ANN001 - local wrapper of sources.io.write
        if args.explain:
            df.explain("formatted")
        _write(df, location, fmt, **options)

    spark = build_session(args.master, app_name=f"edflux-{args.cmd}", shuffle_partitions=args.shuffle_partitions)
    if args.cmd == "rollup":
        a = SwitchingAnalysis(
            read_purchases(spark, args.purchases, args.purchases_format),
            read_editions(spark, args.editions, args.editions_format, strict=args.strict),
            args.as_of,
            args.lookback_days,
            args.window_days,
            args.closing_days,
            args.strict,
            args.checkpoint,
            counters=JobCounters() if args.metrics_out else None,
        )
        parts = [c for c in args.partition_by.split(",") if c]
        write(a.rollup, args.out, args.out_format, **({"partitionBy": parts} if parts else {}))
        if args.metrics_out:
            table = a.counters.table(a.purchases, a.editions, a.recent, a.windows)
            write(table, args.metrics_out, args.metrics_out_format)
        if args.recurrent_out:
            stored = read_rollup(spark, args.out, args.out_format)
            write(recurrent(stored, args.min_editions), args.recurrent_out, args.recurrent_out_format)
    elif args.cmd == "recurrent":
        stored = read_rollup(spark, args.rollup, args.rollup_format)
        write(recurrent(stored, args.min_editions), args.out, args.out_format)
    elif args.cmd == "flow":
        stored = read_rollup(spark, args.rollup, args.rollup_format)
        editions = read_editions(spark, args.editions, args.editions_format)
        write(migration_flow(stored, editions), args.out, args.out_format)
    elif args.cmd == "single-window":
        out = rollup_single_window(
            read_purchases(spark, args.purchases, args.purchases_format),
            read_editions(spark, args.editions, args.editions_format),
            args.closing_days,
        )
        write(out, args.out, args.out_format)
    return 0


if __name__ == "__main__":
    sys.exit(main())
