"""Command line: build every model, or load newly landed monthly files.

  python -m farelane build --green G --yellow Y --fhv F --zones Z --target OUT [--fhv-year 2019 ...]
  python -m farelane ingest --service green --landing DIR --target TABLE_DIR --checkpoint DIR

Inputs are CSV paths or globs with the raw layouts (``schemas.py``); the zone
seed is the lookup CSV.  Outputs are Parquet folders; use shared storage on a
cluster.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    from farelane.session import DEFAULT_CONF, ensure_checkpoint_dir
    b = SparkSession.builder.appName("farelane")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="farelane")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="build staging, core, marts, reports and data tests")
    for name in ("green", "yellow", "fhv", "zones", "target"):
        b.add_argument(f"--{name}", required=True)
    b.add_argument("--fhv-year", type=int, default=2019)
    b.add_argument("--year", type=int, default=2020)
    b.add_argument("--previous-year", type=int, default=2019)
    b.add_argument("--fare-month", default="2020-04")
    b.add_argument("--tt-month", default="2019-11")
    b.add_argument("--tt-zones", default="Newark Airport,SoHo,Yorkville East")
    b.add_argument("--from-targets", action="store_true",
                   help="the three trip inputs are targets of the ingest command, not CSV")
    b.add_argument("--input-gb", type=float, default=None,
                   help="size shuffles and scan splits for this much input")
    b.add_argument("--test-run", action="store_true", help="sample 100 rows per staging model")
    b.add_argument("--fail-on-error", action="store_true", help="fail when an error-severity test fails")
    i = sub.add_parser("ingest", help="insert-only load of newly landed monthly files")
    for name in ("service", "landing", "target", "checkpoint"):
        i.add_argument(f"--{name}", required=True)
    args = ap.parse_args(argv)

    spark = _session()
    if args.cmd == "build":
        from farelane.plans.build import BuildParams, build_warehouse, model_counts
        from farelane.plans.ingest import target_trips
        from farelane.session import apply_scale_conf
        from farelane.sources.readers import read_trips, read_zones
        params = BuildParams(fhv_year=args.fhv_year, year=args.year, previous_year=args.previous_year,
                             fare_month=args.fare_month, tt_month=args.tt_month,
                             tt_zones=[z.strip() for z in args.tt_zones.split(",") if z.strip()],
                             test_run=args.test_run)
        if args.input_gb is not None:
            apply_scale_conf(spark, int(args.input_gb * (1 << 30)), spark.sparkContext.defaultParallelism)
        trips = target_trips if args.from_targets else read_trips
        models = build_warehouse(spark, *[trips(spark, getattr(args, s), s) for s in ("green", "yellow", "fhv")],
                                 read_zones(spark, args.zones), args.target, params, fail_on_error=args.fail_on_error)
        counts = {r.model: r.rows for r in model_counts(models).collect()}
        print(json.dumps(counts))
    else:
        from farelane.plans.ingest import read_target
        from farelane.streaming.ingest_stream import ingest_stream
        ingest_stream(spark, args.service, args.landing, args.target, args.checkpoint)
        print(json.dumps({"rows_in_target": read_target(spark, args.target, args.service).count()}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
