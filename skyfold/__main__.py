"""Command line: the batch steps and the incremental run.

    python -m skyfold process   --landing L --processed P [--day 2026-03-08] [--multi-line]
    python -m skyfold load      --processed P --history H [--day 2026-03-08] [--marts M]
    python -m skyfold marts     --history H --marts M [--touched 2026-03-07,2026-03-08]
    python -m skyfold accumulate --landing L --history H --checkpoint C [--multi-line]
    python -m skyfold expire    --table T --column ingest_date --days 90 [--as-of 2026-03-08]

Histories and marts are folders or names (a table, a database); with ``--marts``,
``load`` and ``accumulate`` go on to the marts of the partitions they touched.
``--box`` keeps the vectors within a bounding box (``default`` for the preset's,
or min and max latitude, min and max longitude).
``--day`` defaults to today in the preset's local zone. The session comes
from ``spark-submit`` / the environment; ``--master`` is for local runs.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from zoneinfo import ZoneInfo

from skyfold.plans.preset import BOUNDING_BOX, LOCAL_ZONE, RETENTION_DAYS


def today_local() -> str:
    return dt.datetime.now(ZoneInfo(LOCAL_ZONE)).date().isoformat()


def box_of(text: str) -> tuple[float, float, float, float]:
    """``default`` or four numbers: min and max latitude, min and max longitude."""
    if text == "default":
        return BOUNDING_BOX
    parts = tuple(float(x) for x in text.split(","))
    if len(parts) != 4:
        raise argparse.ArgumentTypeError(f"four numbers wanted, not {text!r}")
    return parts


def partition_values(text: str) -> list[dt.date | None]:
    """Comma-separated days; ``null`` is the partition of rows without a time."""
    return [None if x == "null" else dt.date.fromisoformat(x) for x in text.split(",") if x]


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="skyfold")
    parser.add_argument("--master", default=None, help="e.g. local[*]; omit under spark-submit")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("process")
    p.add_argument("--landing", required=True)
    p.add_argument("--processed", required=True)
    p.add_argument("--day", default=None)
    p.add_argument("--all-days", action="store_true")
    p.add_argument("--multi-line", action="store_true")
    p.add_argument("--as-of", default=None, help="processing time to stamp, e.g. 2026-03-08T12:00:00")
    p.add_argument("--dated-folders", action="store_true", help="landing uses <root>/<yyyy-MM-dd>/ folders")
    p.add_argument("--box", type=box_of, default=None)
    p = sub.add_parser("load")
    p.add_argument("--processed", required=True)
    p.add_argument("--history", required=True)
    p.add_argument("--day", default=None)
    p.add_argument("--all-days", action="store_true")
    p.add_argument("--count-total", action="store_true")
    p.add_argument("--marts", default=None, help="then build the marts of the touched partitions")
    p.add_argument("--order-by", action="append", metavar="EXPR",
                   help="where a key repeats keep the row with the smallest value, e.g. --order-by=-last_contact")
    p = sub.add_parser("marts")
    p.add_argument("--history", required=True)
    p.add_argument("--marts", required=True)
    p.add_argument("--touched", type=partition_values, default=None, metavar="DAYS",
                   help="history partitions changed since the last run; omit for all")
    p = sub.add_parser("accumulate")
    p.add_argument("--landing", required=True)
    p.add_argument("--history", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--multi-line", action="store_true")
    p.add_argument("--max-files-per-trigger", type=int, default=None)
    p.add_argument("--order-by", action="append", metavar="EXPR", help="as in load")
    p.add_argument("--dated-folders", action="store_true", help="landing uses <root>/<yyyy-MM-dd>/ folders")
    p.add_argument("--box", type=box_of, default=None)
    p.add_argument("--marts", default=None, help="then build the marts of the touched partitions")
    p = sub.add_parser("expire")
    p.add_argument("--table", required=True)
    p.add_argument("--column", default="ingest_date")
    p.add_argument("--days", type=int, default=RETENTION_DAYS)
    p.add_argument("--as-of", default=None)
    args = parser.parse_args(argv)

    from pyspark.sql import SparkSession

    from skyfold.session import DEFAULT_CONF, ensure_checkpoint_dir

    builder = SparkSession.builder.appName(f"skyfold-{args.command}")
    if args.master:
        builder = builder.master(args.master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    try:
        out = run(spark, args)
    finally:
        spark.stop()
    print(json.dumps(out, default=str))
    return 0


def run(spark, args) -> dict:
    from skyfold.plans import steps
    from skyfold.plans.tables import expire_partitions
    from skyfold.streaming import accumulate
    from skyfold.streaming.incremental import MAX_FILES_PER_TRIGGER

    order = None
    if getattr(args, "order_by", None):
        from pyspark.sql import functions as F

        order = [F.expr(e) for e in args.order_by]
    day = None if getattr(args, "all_days", False) else (getattr(args, "day", None) or today_local())
    if args.command == "process":
        from pyspark.sql import functions as F

        stamp = F.lit(args.as_of).cast("timestamp") if args.as_of else None
        res = steps.process_day(spark, args.landing, args.processed, day,
                                ingested_at=stamp, multi_line=args.multi_line,
                                dated_folders=args.dated_folders, box=args.box)
        report = {name: [r.asDict() for r in df.collect()] for name, df in res.pop("report").items()}
        return {**res, "day": day, "report": report}
    if args.command == "load":
        out = steps.load_history(spark, args.processed, args.history, day, count_total=args.count_total, dedup_order=order)
        return {**out, "day": day, **_marts_of(spark, args, out["touched"])}
    if args.command == "marts":
        return steps.build_mart_tables(spark, args.history, args.marts, args.touched)
    if args.command == "accumulate":
        out = accumulate(spark, args.landing, args.history, args.checkpoint,
                         dated_folders=args.dated_folders,
                         multi_line=args.multi_line,
                         key_order=order, box=args.box,
                         max_files_per_trigger=args.max_files_per_trigger or MAX_FILES_PER_TRIGGER)
        return {**out, **_marts_of(spark, args, out["touched"])}
    if args.command == "expire":
        removed = expire_partitions(spark, args.table, args.column, args.days,
                                    args.as_of or today_local())
        return {"removed": removed}
    raise ValueError(args.command)


def _marts_of(spark, args, touched: list | None) -> dict:
    from skyfold.plans import steps

    return {"marts": steps.build_mart_tables(spark, args.history, args.marts, touched)} if args.marts else {}


if __name__ == "__main__":
    sys.exit(main())
