"""Command line, for spark-submit or ``python -m sitescout``.

    build  --source DIR --out DIR [--previous DIR] [--jobs a,b] [--min-similarity T] [--word-lists] [--name-gender]
    report --tables DIR --lat LAT --lon LON --categories A,B [--km KM] --out DIR
    search --tables DIR --text TEXT [--min-chars N] [--limit N]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from sitescout.operators.categories import category_search
from sitescout.plans import etl, report
from sitescout.settings import SETTINGS, TABLES
from sitescout.sources.tables import read_table


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="sitescout")
    commands = main.add_subparsers(dest="command", required=True)

    build = commands.add_parser("build", help="build the derived tables from raw files")
    build.add_argument("--source", required=True)
    build.add_argument("--out", required=True)
    build.add_argument("--previous", help="tables of an earlier run, to write the new rows over")
    build.add_argument("--jobs", default=",".join(etl.JOBS))
    build.add_argument("--mode", default="FAILFAST", choices=["FAILFAST", "PERMISSIVE", "DROPMALFORMED"])
    build.add_argument("--min-similarity", type=float, default=SETTINGS.containment_threshold)

    build.add_argument("--word-lists", action="store_true", help="lexicon from two word lists")
    build.add_argument("--name-gender", action="store_true", help="genders from name_gender.csv")

    site = commands.add_parser("report", help="report on a candidate site")
    site.add_argument("--tables", required=True)
    site.add_argument("--lat", required=True)
    site.add_argument("--lon", required=True)
    site.add_argument("--categories", required=True, help="separated by commas")
    site.add_argument("--km", default=SETTINGS.default_radius_km)
    site.add_argument("--out", required=True, help="directory for the report, as Parquet")

    search = commands.add_parser("search", help="suggest categories")
    search.add_argument("--tables", required=True)
    search.add_argument("--text", required=True)
    search.add_argument("--min-chars", type=int, default=SETTINGS.suggestion_min_chars)
    search.add_argument("--limit", type=int, default=SETTINGS.suggestion_limit)
    return main


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "build":
        job = etl.Run(
            spark, args.source, args.out, args.previous, args.mode, args.min_similarity,
            args.word_lists, args.name_gender,
        )
        etl.run_jobs(job, args.jobs.split(","))
        return
    if args.command == "search":
        if len(args.text) < args.min_chars:
            raise SystemExit(f"give at least {args.min_chars} characters")
        known = read_table(spark, args.tables, TABLES.categories)
        category_search(known, args.text, args.limit).show(args.limit, truncate=False)
        return
    stored = report.SiteTables(
        directory=read_table(spark, args.tables, TABLES.directory),
        business_categories=read_table(spark, args.tables, TABLES.business_categories),
        checkin_daily=read_table(spark, args.tables, TABLES.checkin_daily),
        checkin_hourly=read_table(spark, args.tables, TABLES.checkin_hourly),
        sentiments=read_table(spark, args.tables, TABLES.sentiments),
    )
    found = report.site_report(stored, args.categories, args.lat, args.lon, args.km)
    lines = report.report_lines(found)
    lines.write.mode("errorifexists").parquet(args.out)


def main() -> None:
    args = parser().parse_args()
    spark = SparkSession.builder.appName("sitescout").getOrCreate()
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
