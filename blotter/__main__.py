"""Command line entry for the monthly build: ``python -m blotter build ...``, or with
spark-submit ``spark-submit --py-files blotter.zip blotter/__main__.py build ...``::

    python -m blotter build --landing-root s3://bucket/landing \\
        --out-root s3://bucket/warehouse --months 2025-01,2025-02

Exits with status 1 when any check of the report has failures and ``--strict`` is given.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="blotter")
    sub = parser.add_subparsers(dest="command", required=True)
    build = sub.add_parser("build", help="load months, flatten, build marts, run checks")
    src = build.add_mutually_exclusive_group(required=True)
    src.add_argument("--landing-root", help="landing zone: <root>/<dataset>/<key>=<yyyy-MM>/")
    src.add_argument("--tables", help="folder of the generated test tables (orders, lineitem, events)")
    build.add_argument("--out-root", help="where raw, flattened, mart and check tables live")
    build.add_argument("--months", help="comma-separated yyyy-MM months to (re)load; default all")
    build.add_argument("--threads", type=int, default=4, help="concurrent write jobs per layer")
    build.add_argument("--multiline", action="store_true", help="landing files hold arrays or records over several lines")
    build.add_argument("--strict", action="store_true", help="exit 1 if any check has failures")
    args = parser.parse_args(argv)

    from pyspark.sql import SparkSession

    from blotter.plans.build import build_all

    spark = SparkSession.builder.appName("blotter-build").getOrCreate()
    months = [m.strip() for m in args.months.split(",")] if args.months else None
    out = build_all(
        spark,
        sf_dir=args.tables,
        landing_root=args.landing_root,
        out_root=args.out_root,
        threads=args.threads,
        months=months,
        multiline=args.multiline,
    )
    report = out["report"]
    report.orderBy("model", "check_name", "column_name").show(200, truncate=False)
    failing = report.where("failures > 0").count()
    print(f"marts: {out['mart']}")
    return 1 if args.strict and failing else 0


if __name__ == "__main__":
    sys.exit(main())
