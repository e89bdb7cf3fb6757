"""Command line: ``python -m tocsin run``, ``sql`` and ``generate``."""

from __future__ import annotations

import argparse
import csv
import sys
from datetime import date

from pyspark.sql import functions as F

from tocsin.config import ScoringConfig
from tocsin.operators import datagen
from tocsin.operators.reports import kpi_cards
from tocsin.plans.batch import run_batch, staged_views
from tocsin.schemas import RAW_DRUGS
from tocsin.session import build_session
from tocsin.sources.files import read_csv, read_raw, read_table, write_csv
from tocsin.sources.views import register_views, run_sql


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tocsin")
    commands = parser.add_subparsers(dest="command", required=True)

    run = commands.add_parser("run", help="score the raw CSV files of a folder")
    run.add_argument("--data", required=True)
    run.add_argument("--out", required=True)
    run.add_argument("--quarter", required=True, help="current quarter, e.g. 2024-Q1")
    run.add_argument("--as-of", type=date.fromisoformat, default=None)

    sql = commands.add_parser("sql", help="query the raw and staged tables of a folder")
    sql.add_argument("--data", required=True)
    sql.add_argument("--quarter", required=True)
    sql.add_argument("--as-of", type=date.fromisoformat, default=None)
    sql.add_argument("--out", help="folder for all rows as CSV part files; else they are printed")
    sql.add_argument("query")

    generate = commands.add_parser("generate", help="make synthetic reports and volumes")
    generate.add_argument("--data", required=True, help="folder with drugs.csv; output goes there")
    generate.add_argument("--reports", type=int, default=8000)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session()
    if args.command == "run":
        cfg = ScoringConfig(current_quarter=args.quarter, as_of=args.as_of)
        run_batch(spark, args.data, args.out, cfg).show(truncate=False)
        kpi_cards(read_table(spark, f"{args.out}/tables/risk_watchlist")).show()
        return
    if args.command == "sql":
        cfg = ScoringConfig(current_quarter=args.quarter, as_of=args.as_of)
        raw = read_raw(spark, args.data)
        register_views({**raw, **staged_views(raw, cfg)})
        result = run_sql(spark, args.query)
        if args.out:
            write_csv(result, args.out)
            return
        rows = csv.writer(sys.stdout)
        rows.writerow(result.columns)
        rows.writerows(result.toLocalIterator())  # one partition at a time
        return
    portfolio = datagen.demo_portfolio(read_csv(spark, f"{args.data}/drugs.csv", RAW_DRUGS))
    reports = spark.range(1, args.reports + 1).select(F.col("id").alias("report_id"))
    write_csv(datagen.generate_events(reports, portfolio), f"{args.data}/adverse_events.csv")
    write_csv(datagen.generate_sales(portfolio), f"{args.data}/sales_volume.csv")


if __name__ == "__main__":
    main()
