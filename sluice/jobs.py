"""Command-line jobs (for spark-submit or python -m sluice.jobs).

  bulk-load    --source S --table NAME=PATH ... --landing L --warehouse W --log LOG
  rate-load    --rates PATH --table T --log LOG --currencies GBP,BRL [--today D]
  rate-stream  --landing FOLDER --table T --checkpoint C [--log LOG]
  build        --warehouse W --source S --rates T --mart M
  freshness    --rates T [--field TIME_PERIOD] [--now TS] [--warn-days 4] [--error-days 6]
  log-report   --log LOG
  vacuum       --table T [--keep 2]

Exit code 1 when a table failed to load or a blocking test failed.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import functions as F

from .functions.text import parse_codes
from .operators.tables import VersionedTable
from .session import build_session, scale_conf

RAW_TABLES = ["orders", "customers", "order_items", "order_payments", "order_reviews",
              "products", "sellers", "geolocation", "product_category_name_translation"]


def _session(args):
    extra = scale_conf(int(args.input_gb * 2**30)) if args.input_gb else None
    partitions = None if (args.master is None or args.input_gb) else args.shuffle_partitions
    return build_session(args.master, partitions, app_name=f"sluice-{args.command}", extra=extra)


def cmd_bulk_load(args) -> int:
    from .plans.bulk_load import BulkLoadFailed, bulk_load

    spark = _session(args)
    manifest = dict(item.split("=", 1) for item in args.table)
    if args.only:
        wanted = {t.strip() for t in args.only.split(",") if t.strip()}
        manifest = {t: p for t, p in manifest.items() if t in wanted}
    if args.retry_failed:
        from . import fs
        from .operators import runlog

        if not fs.exists(spark, args.log):
            print("nothing to retry: no load log yet")
            return 0
        log = runlog.read_log(spark, args.log).filter(F.col("source") == args.source)
        failed = {r["table_name"] for r in runlog.failed_tables(log).collect()}  # one row per table
        manifest = {t: p for t, p in manifest.items() if t in failed}
        print(f"retrying: {', '.join(sorted(manifest)) or 'nothing'}")
        if not manifest:
            return 0
    load_date = dt.date.fromisoformat(args.load_date) if args.load_date else None
    try:
        report = bulk_load(spark, manifest, args.landing, args.warehouse, args.log, args.source,
                           load_date=load_date, parallel_tables=args.parallel,
                           quoted_newlines={t.strip(): False for t in args.single_line.split(",") if t.strip()})
    except BulkLoadFailed as exc:
        print(f"{exc.report.summary()}: {', '.join(exc.report.failures)}")
        for t in exc.report.failures:
            print(f"FAILED {t}: {exc.report.results[t].error}")
        return 1
    print(report.summary())
    return 0


def cmd_rate_load(args) -> int:
    from .plans import rate_load

    spark = _session(args)

    def rates(since):
        return rate_load.validate_rate_source(spark, args.rates, since=since)

    today = dt.date.fromisoformat(args.today) if args.today else dt.date.today()
    try:
        out = rate_load.incremental_load(spark, rates, args.table, args.log,
                                         parse_codes(args.currencies), today, source_uri=args.rates,
                                         use_default_start=args.use_default_start)
    except Exception as exc:  # noqa: BLE001 - reported, logged by the job, exit 1
        print(f"FAILED rates: {type(exc).__name__}: {exc}")
        return 1
    print(f"rates: {out['rows']} rows for {out['start']} -> {out['end']}")
    return 0


def cmd_rate_stream(args) -> int:
    from .sources.csv_files import read_header
    from .streaming.rate_stream import run_rate_stream

    spark = _session(args)
    columns = read_header(spark, args.landing)
    try:
        table = run_rate_stream(spark, args.landing, columns, args.table, args.checkpoint, log_path=args.log)
    except Exception as exc:  # noqa: BLE001 - reported, logged by the stream, exit 1
        print(f"FAILED rates: {type(exc).__name__}: {exc}")
        return 1
    print(f"rates table at version {table.version()}")
    return 0


def cmd_build(args) -> int:
    from .plans.build import build
    from .plans.rate_load import RATE_PARTITION

    spark = _session(args)
    raw = {}
    for name in RAW_TABLES:
        t = VersionedTable(spark, f"{args.warehouse}/{args.source}_{name}")
        if t.exists():
            raw[f"raw_{name}"] = t.read()
    raw["raw_fx_rates"] = VersionedTable(spark, args.rates, RATE_PARTITION).read()
    result = build(spark, raw, args.mart)
    tests = result.tests.cache()     # small: one row per test
    for r in tests.orderBy("test_name").collect():
        print(f"{r['status']:5s} {r['test_name']} ({r['failures']})")
    blocking = [r["test_name"] for r in tests.filter(F.col("status") == "error").collect()]
    print(f"fct_orders: {result.fct_rows} rows; {len(blocking)} blocking test(s)")
    return 1 if blocking else 0


def cmd_freshness(args) -> int:
    """Age of the newest rate (field TIME_PERIOD by default) at --now."""
    from .operators.quality import freshness
    from .plans.rate_load import RATE_PARTITION

    spark = _session(args)
    rates = VersionedTable(spark, args.rates, RATE_PARTITION).read()
    field = F.col(args.field).cast("timestamp_ntz")
    now = dt.datetime.fromisoformat(args.now) if args.now else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    r = freshness(rates, field, now, args.warn_days, args.error_days).first()
    print(f"{r['status']} newest={r['max_loaded_at']} age_seconds={r['age_seconds']}")
    return 1 if r["status"] == "error" else 0


def cmd_log_report(args) -> int:
    """Dead runs, tables whose latest outcome failed, and load-day skew."""
    from .operators import runlog

    spark = _session(args)
    log = runlog.read_log(spark, args.log)
    sections = {"dead runs": runlog.dead_runs(log), "failed tables": runlog.failed_tables(log),
                "load skew": runlog.load_skew(log)}
    bad = 0
    for title, df in sections.items():
        rows = df.collect()          # reports: one row per run/table, small
        print(f"{title}: {len(rows)}")
        for r in rows:
            print("  " + ", ".join(f"{k}={v}" for k, v in r.asDict().items()))
        bad += len(rows)
    return 1 if bad else 0


def cmd_vacuum(args) -> int:
    """Remove data folders and commits older than the retained versions."""
    spark = _session(args)
    removed = VersionedTable(spark, args.table).vacuum(args.keep)
    print(f"removed {len(removed)} data folder(s)")
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sluice.jobs")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    p.add_argument("--shuffle-partitions", type=int, default=8)
    p.add_argument("--input-gb", type=float, default=None,
                   help="input volume: sizes shuffle partitions and splits (session.scale_conf)")
    sub = p.add_subparsers(dest="command", required=True)
    b = sub.add_parser("bulk-load")
    b.add_argument("--source", required=True)
    b.add_argument("--table", action="append", required=True, help="NAME=PATH, repeatable")
    b.add_argument("--landing", required=True)
    b.add_argument("--warehouse", required=True)
    b.add_argument("--log", required=True)
    b.add_argument("--load-date")
    b.add_argument("--parallel", type=int, default=4)
    b.add_argument("--single-line", default="",
                   help="comma-separated tables whose fields hold no line breaks: their files are split by block")
    b.add_argument("--only", help="comma-separated subset of the manifest's tables")
    b.add_argument("--retry-failed", action="store_true",
                   help="load only the tables whose latest logged outcome is 'failed'")
    r = sub.add_parser("rate-load")
    r.add_argument("--rates", required=True, help="landed rate CSV file or folder")
    r.add_argument("--table", required=True)
    r.add_argument("--log", required=True)
    r.add_argument("--currencies", required=True)
    r.add_argument("--today")
    r.add_argument("--use-default-start", action="store_true")
    s = sub.add_parser("rate-stream")
    s.add_argument("--landing", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--log", help="load log: started and success or failed of every micro-batch")
    m = sub.add_parser("build")
    m.add_argument("--warehouse", required=True)
    m.add_argument("--source", required=True)
    m.add_argument("--rates", required=True)
    m.add_argument("--mart", required=True)
    f = sub.add_parser("freshness")
    f.add_argument("--rates", required=True)
    f.add_argument("--field", default="TIME_PERIOD")
    f.add_argument("--now")
    f.add_argument("--warn-days", type=int, default=4)
    f.add_argument("--error-days", type=int, default=6)
    lr = sub.add_parser("log-report")
    lr.add_argument("--log", required=True)
    v = sub.add_parser("vacuum")
    v.add_argument("--table", required=True)
    v.add_argument("--keep", type=int, default=2, help="versions to keep readable")
    return p


COMMANDS = {"bulk-load": cmd_bulk_load, "rate-load": cmd_rate_load,
            "rate-stream": cmd_rate_stream, "build": cmd_build, "freshness": cmd_freshness,
            "log-report": cmd_log_report, "vacuum": cmd_vacuum}


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    return COMMANDS[args.command](args)


if __name__ == "__main__":
    sys.exit(main())
