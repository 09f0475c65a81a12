"""Command line: run the refresh, or show a mart of the published star.

    python -m ledgerline etl --csv 'data/*.csv' --base /shared/retail
    python -m ledgerline etl --tables /root/testdata/sf0.01 --base /shared/retail
    python -m ledgerline show overall_kpis --base /shared/retail
"""

from __future__ import annotations

import argparse
import sys

from .config import build_session
from .plans import etl, marts


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerline")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("etl", help="extract, check, build the star, reconcile, publish")
    src = run.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="order-line CSV file(s) or glob")
    src.add_argument("--tables", help="folder of the TPC-H-style test tables")
    run.add_argument("--base", help="publication folder (default: under spark.checkpoint.dir)")
    run.add_argument("--date-format", action="append", help="date pattern(s) of the CSV")
    run.add_argument("--materialise", action="store_true", help="also write the nine views as Parquet marts")
    show = sub.add_parser("show", help="print a view or dashboard dataset of the published star")
    show.add_argument("mart", choices=sorted({**marts.MARTS, **marts.DATASETS}))
    show.add_argument("--base", required=True)
    show.add_argument("--rows", type=int, default=50)
    args = parser.parse_args(argv)

    spark = build_session()
    if args.command == "etl":
        if args.csv:
            from .sources.csv import DEFAULT_DATE_FORMATS, read_orders_csv
            formats = tuple(args.date_format) if args.date_format else DEFAULT_DATE_FORMATS
            source = read_orders_csv(spark, args.csv, date_formats=formats)
        else:
            from .sources.tables import read_tables_source
            source = read_tables_source(spark, args.tables)
        result = etl.run_etl(spark, source, base=args.base, materialise_marts=args.materialise)
        print("quality:", result.quality)
        for row in result.reconciliation:
            print("reconciliation:", row)
        print("stages (s):", result.stage_sec)
        result.summary.show(truncate=False)
        return 0 if all(r["matched"] for r in result.reconciliation) else 1
    etl.served_mart(spark, args.base, args.mart).show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
