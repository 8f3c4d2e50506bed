"""Command line for the batch flow (run with spark-submit or ``python -m vulnlake``).

    python -m vulnlake ingest  --source DIR --bronze PATH [--year 2024] [--layout file|lines] [--rejected PATH] [--keys K ...]
    python -m vulnlake silver  --bronze PATH --core PATH --affected PATH
    python -m vulnlake report  --core PATH --affected PATH [--name g3_1_band_profile ...] [--export DIR]
                               [--as-of 2025-11-17] [--show 20]

Each step reads and writes tables (paths, or ``db.table`` names), so steps can run as separate jobs.
"""

from __future__ import annotations

import argparse
import os
import sys

from .plans.medallion import Layout, build_silver, gold_reports, ingest_bronze, silver_tables
from .session import build_session
from .sources import export_csv


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="vulnlake")
    sub = p.add_subparsers(dest="command", required=True)
    ing = sub.add_parser("ingest", help="document folder -> bronze table")
    ing.add_argument("--source", required=True)
    ing.add_argument("--bronze", required=True)
    ing.add_argument("--rejected")
    ing.add_argument("--year", type=int)
    ing.add_argument("--layout", choices=("file", "lines"), default="file")
    ing.add_argument("--max-records", type=int, help="good documents at most (default: all)")
    ing.add_argument("--keys", nargs="*", help="top-level keys to keep (default: all that occur)")
    sil = sub.add_parser("silver", help="bronze -> core_cves + affected_products")
    sil.add_argument("--bronze", required=True)
    for name in ("core", "affected"):
        sil.add_argument(f"--{name}", required=True)
    sil.add_argument("--buckets", type=int, help="bucket both tables on cve_id (catalog table names only)")
    rep = sub.add_parser("report", help="gold reports over the silver tables")
    for name in ("core", "affected"):
        rep.add_argument(f"--{name}", required=True)
    rep.add_argument("--name", action="append", help="report name (repeatable); default: all")
    rep.add_argument("--as-of", help="reference date for the day-relative reports (default: today)")
    rep.add_argument("--export", help="write each report as CSV under this folder")
    rep.add_argument("--show", type=int, default=20, help="rows to print per report (0: none)")
    return p


def main(argv=None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session()
    if args.command == "ingest":
        layout = Layout(bronze=args.bronze, core="", affected="", rejected=args.rejected)
        counts = ingest_bronze(spark, args.source, layout, year=args.year, doc_layout=args.layout, keys=args.keys or None,
                               max_records=args.max_records)
        print(f"{counts['documents']} documents, {counts['rejected']} rejected")
    elif args.command == "silver":
        build_silver(spark, Layout(bronze=args.bronze, core=args.core, affected=args.affected, buckets=args.buckets))
    else:
        core, aff = silver_tables(spark, Layout(bronze="", core=args.core, affected=args.affected))
        reports = gold_reports(core, aff, as_of=args.as_of)
        names = args.name or list(reports)
        unknown = [n for n in names if n not in reports]
        if unknown:
            print(f"unknown report(s): {', '.join(unknown)}; available: {', '.join(reports)}", file=sys.stderr)
            return 2
        for name in names:
            report = reports[name]()
            if args.export:
                export_csv(report, os.path.join(args.export, name))
            if args.show:
                print(f"== {name}")
                report.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
