"""Run the whole flow on four CSV feeds: land, clean, model, report.

    python -m lakemart --stations s.csv --riders r.csv --payments p.csv --trips t.csv \\
        [--location DIR] [--format parquet] [--reports NAME,...] [--show 20] [--out DIR]

Writes ``bronze.*``, ``silver.*`` and ``gold.*`` tables (under ``--location``
when given), prints a preview of each landed feed, the row counts of every
layer, the gold table listing and column types, and each report (``--show``
rows; ``--out`` also writes every report as parquet there). Everything is computed by Spark; only the printed
preview rows reach the driver.
"""

from __future__ import annotations

import argparse

from lakemart.operators import row_counts
from lakemart.plans import marts
from lakemart.plans.lakehouse import materialize, read_csv_feeds
from lakemart.schemas import GOLD_TABLES, SILVER_TABLES
from lakemart.session import build_session
from lakemart.sources.catalog import count_sql, describe_tables, show_tables


def parse_args(argv=None):
    p = argparse.ArgumentParser(prog="lakemart", description=__doc__.splitlines()[0])
    for feed in SILVER_TABLES:
        p.add_argument(f"--{feed}", required=True, help=f"header-less CSV file or folder of the {feed} feed")
    p.add_argument("--location", help="shared folder for the layer schemas (default: the warehouse)")
    p.add_argument("--format", default="parquet", help="table format of the layers")
    p.add_argument("--reports", help="comma list of reports (default: all)")
    p.add_argument("--show", type=int, default=20, help="rows of each report to print")
    p.add_argument("--out", help="also write every report as parquet under this folder")
    p.add_argument("--master", help="Spark master (default: from the environment)")
    return p.parse_args(argv)


def main(argv=None) -> None:
    args = parse_args(argv)
    spark = build_session(args.master)
    raw = read_csv_feeds(spark, {feed: getattr(args, feed) for feed in SILVER_TABLES})
    layers = materialize(spark, raw, fmt=args.format, location=args.location)

    for name in SILVER_TABLES:  # A13: bounded preview of each landed feed
        print(f"== bronze.{name}")
        layers.raw[name].show(args.show, truncate=False)

    named = [(f"bronze.{n}", layers.raw[n]) for n in SILVER_TABLES]
    named += [(f"silver.{n}", layers.silver[n]) for n in SILVER_TABLES]
    named += [(f"gold.{n}", layers.gold[n]) for n in GOLD_TABLES]
    row_counts(named).show(len(named), truncate=False)
    show_tables(spark, "gold").show(truncate=False)
    describe_tables(spark, "gold", GOLD_TABLES).show(200, truncate=False)
    spark.sql(count_sql("gold", GOLD_TABLES)).show(truncate=False)

    wanted = args.reports.split(",") if args.reports else list(marts.REPORTS)
    for name in wanted:
        report = marts.REPORTS[name](layers)
        print(f"== {name}")
        report.show(args.show, truncate=False)
        if args.out:
            report.write.mode("overwrite").parquet(f"{args.out}/{name}")


if __name__ == "__main__":
    main()
