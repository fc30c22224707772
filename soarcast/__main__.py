"""Command line: ``python -m soarcast <command> ...`` or, on a cluster,
``spark-submit --py-files soarcast.zip submit.py <command> ...``.

Commands
  ingest     decoded grid cubes -> one year of the raw zone
  transform  raw zone -> transformed zone
  marts      transformed zone -> curated marts (all, or the ones named)
  batch      transform + marts (+ export with --jdbc-url)
  export     curated marts -> database tables
  live       start the live views on a topic or a JSON-lines folder
"""

from __future__ import annotations

import argparse
import json
import sys

from .schemas import RAW_VARIABLES
from .session import build_session, utc_session


def _spark(args):
    return build_session(app_name=f"soarcast-{args.command}")


def _jdbc(args) -> dict | None:
    if not args.jdbc_url:
        return None
    return {"url": args.jdbc_url, "properties": json.loads(args.jdbc_properties or "{}")}


def main(argv: list[str] | None = None, spark=None) -> int:
    """Run one command; a session passed in is used and left running."""
    p = argparse.ArgumentParser(prog="soarcast")
    sub = p.add_subparsers(dest="command", required=True)

    ig = sub.add_parser("ingest", help="decoded cubes (Parquet, one array per dimension/variable) -> raw year")
    ig.add_argument("--cubes", required=True)
    ig.add_argument("--raw", required=True)
    ig.add_argument("--year", type=int, required=True)
    ig.add_argument("--dims", nargs="+", default=["time", "latitude", "longitude"])
    ig.add_argument("--variables", nargs="+", default=list(RAW_VARIABLES))

    t = sub.add_parser("transform")
    t.add_argument("--raw", required=True)
    t.add_argument("--zone", required=True)
    t.add_argument("--years", type=int, nargs="*")
    t.add_argument("--laid-out", action="store_true", help="the raw zone was written by 'ingest': no second shuffle")

    m = sub.add_parser("marts")
    m.add_argument("--zone", required=True)
    m.add_argument("--marts-root", required=True)
    m.add_argument("names", nargs="*")

    b = sub.add_parser("batch")
    b.add_argument("--raw", required=True)
    b.add_argument("--zone", required=True)
    b.add_argument("--marts-root", required=True)
    b.add_argument("--years", type=int, nargs="*")
    b.add_argument("--laid-out", action="store_true", help="the raw zone was written by 'ingest': no second shuffle")
    b.add_argument("--jdbc-url")
    b.add_argument("--jdbc-properties", help="JSON object, e.g. user/password/driver")

    e = sub.add_parser("export")
    e.add_argument("--marts-root", required=True)
    e.add_argument("--jdbc-url", required=True)
    e.add_argument("--jdbc-properties")

    lv = sub.add_parser("live")
    lv.add_argument("--marts-root", required=True, help="folder holding the q3 mart (baseline)")
    lv.add_argument("--sink-root", help="Parquet sink folder (one table per sink)")
    lv.add_argument("--jdbc-url", help="database for the five live tables (instead of Parquet)")
    lv.add_argument("--jdbc-properties")
    lv.add_argument("--source", required=True, help="JSON-lines folder, or a JSON object of Kafka options")
    lv.add_argument("--checkpoint-dir")
    lv.add_argument("--trigger", default="2 minutes", help="processing-time interval, or 'available-now'")
    lv.add_argument("--strict-nulls", action="store_true", help="NULL labels and scores where an input is NULL")
    lv.add_argument("--deduplicate", action="store_true", help="drop events that the producer sent again")
    lv.add_argument("--log", help="folder for the progress table; failed queries are restarted with growing pauses")
    lv.add_argument("--state-partitions", type=int, help="state partitions of the windowed queries (first start)")

    args = p.parse_args(argv)
    if args.command == "live" and not (args.sink_root or args.jdbc_url):
        p.error("live needs --sink-root or --jdbc-url")
    own_session = spark is None
    spark = spark or _spark(args)

    if args.command == "ingest":
        from .sources import flatten_cube, replace_year

        cubes = spark.read.parquet(args.cubes)
        missing = [v for v in args.variables if v not in cubes.columns]
        if missing:
            raise ValueError(f"the cubes lack {', '.join(missing)}; they have {', '.join(cubes.columns)}")
        with utc_session(spark):
            replace_year(flatten_cube(cubes, args.dims, args.variables), args.raw, args.year)
    elif args.command == "transform":
        from .plans import refresh_zone

        refresh_zone(spark, args.raw, args.zone, args.years or None, rebalance=not args.laid_out)
    elif args.command == "marts":
        from .plans import build_marts
        from .sources import read_transformed

        with utc_session(spark):
            for path in build_marts(spark, read_transformed(spark, args.zone), args.marts_root, args.names or None).values():
                print(path)
    elif args.command == "batch":
        from .plans import run_batch

        written = run_batch(spark, args.raw, args.zone, args.marts_root, years=args.years or None, export=_jdbc(args),
                            rebalance=not args.laid_out)
        print(json.dumps(written, indent=2))
    elif args.command == "export":
        from .sources import export_marts

        jdbc = _jdbc(args)
        print(json.dumps(export_marts(spark, args.marts_root, jdbc["url"], jdbc["properties"]), indent=2))
    elif args.command == "live":
        from .operators import hourly_baseline
        from .sources import read_mart
        from .streaming import SINK_NAMES, ProgressLog, jdbc_batch_writer, jdbc_statement, parquet_batch_writer, start_live, supervise

        source = json.loads(args.source) if args.source.lstrip().startswith("{") else args.source
        def baseline():  # re-read every micro-batch: follows the nightly mart rewrite
            return hourly_baseline(read_mart(spark, args.marts_root, "q3_hourly_conditions"))

        sinks = {}
        if args.sink_root:
            sinks = {name: parquet_batch_writer(args.sink_root, name) for name in SINK_NAMES}
        if args.jdbc_url:
            jdbc = _jdbc(args)
            for name in SINK_NAMES[:-1]:  # the five live tables; rejected rows stay on storage
                sinks[name] = jdbc_batch_writer(name, jdbc["url"], jdbc["properties"], run_statement=jdbc_statement(spark, jdbc["url"], jdbc["properties"]))
        trigger = {"availableNow": True} if args.trigger == "available-now" else {"processingTime": args.trigger}

        def start():
            return start_live(spark, source, baseline, sinks, checkpoint_dir=args.checkpoint_dir, trigger=trigger,
                              state_partitions=args.state_partitions, strict_nulls=args.strict_nulls, deduplicate=args.deduplicate)

        if args.log:
            supervise(start, ProgressLog(spark, args.log))
        elif args.trigger == "available-now":
            for q in start().queries.values():
                q.awaitTermination()
        else:
            start().await_any()
    if own_session:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
