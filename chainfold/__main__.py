"""Command line: run one layer (or the whole day) for a block date.

    python -m chainfold bronze --root LAKE --date 2024-11-23 [--pages DIR] [--staging DIR]
    python -m chainfold silver --root LAKE --date 2024-11-23
    python -m chainfold gold   --root LAKE --date 2024-11-23
    python -m chainfold topk   --root LAKE [--k 5] [--date 2024-11-23]
    python -m chainfold daily  --root LAKE --date 2024-11-23 [--pages DIR] [--staging DIR]

Under ``spark-submit`` the session comes from the submit settings; ``--master``
only applies when none is set. Bronze reads landed query-result pages for
the day and falls back to staging header CSV files when the pages are
missing, empty or broken; rows of any other day fail the write, and a day
without rows ends the run with status 1 and leaves the lake as it was.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import DataFrame, SparkSession

from chainfold.plans import medallion as M
from chainfold.schemas import LABELLED, conform
from chainfold.sources.files import read_csv_strings, read_or_fallback, read_result_pages


def _session(master: str | None) -> SparkSession:
    builder = SparkSession.builder.appName("chainfold")
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def _day(text: str) -> str:
    return dt.date.fromisoformat(text).isoformat()


def bronze_rows(spark: SparkSession, pages: str | None, staging: str | None) -> DataFrame:
    """The day's labelled rows: result pages if present, else staging CSV."""

    def from_pages() -> DataFrame:
        if not pages:
            raise FileNotFoundError("no pages given")
        return read_result_pages(spark, pages, LABELLED)

    def from_staging() -> DataFrame:
        if not staging:
            raise SystemExit("no rows: result pages are missing or empty and no --staging folder was given")
        return conform(read_csv_strings(spark, staging), LABELLED, strict=True)

    try:
        return read_or_fallback(from_pages, from_staging)
    except FileNotFoundError:
        return from_staging()


def run_bronze(spark: SparkSession, root: str, day: str, pages: str | None, staging: str | None, fmt: str = "parquet") -> None:
    M.land_bronze(bronze_rows(spark, pages, staging), root, day=day, fmt=fmt)


def run_silver(spark: SparkSession, root: str, day: str, event_name: str = "Transfer", fmt: str = "parquet") -> DataFrame:
    return M.build_silver(spark, root, [day], event_name=event_name, fmt=fmt)


def run_gold(spark: SparkSession, root: str, day: str) -> None:
    d = dt.date.fromisoformat(day)
    M.build_gold(spark, root, year=d.year, month=d.month)


def run_topk(spark: SparkSession, root: str, k: int, day: str | None = None) -> None:
    year = month = None
    if day:
        d = dt.date.fromisoformat(day)
        year, month = d.year, d.month
    for (dim, measure), df in M.top_k_report(spark, root, k, year=year, month=month).items():
        print(f"top {k} {dim} by {measure}")
        df.show(k, truncate=False)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="chainfold")
    ap.add_argument("step", choices=["bronze", "silver", "gold", "topk", "daily"])
    ap.add_argument("--root", required=True, help="lake folder holding bronze/, silver/ and gold/")
    ap.add_argument("--date", type=_day, help="block date YYYY-MM-DD")
    ap.add_argument("--pages", help="folder of landed result pages for the day")
    ap.add_argument("--staging", help="folder or glob of staging header CSV files for the day")
    ap.add_argument("--bronze-format", choices=["parquet", "csv"], default="parquet")
    ap.add_argument("--event-name", default="Transfer")
    ap.add_argument("--k", type=int, default=5)
    ap.add_argument("--master", help="Spark master when not set by spark-submit")
    args = ap.parse_args(argv)
    if args.step != "topk" and not args.date:
        ap.error("--date is required")
    spark = _session(args.master)
    if args.step in ("bronze", "daily"):
        try:
            run_bronze(spark, args.root, args.date, args.pages, args.staging, args.bronze_format)
        except M.EmptyInput as err:
            print(f"{err}; nothing was written", file=sys.stderr)
            return 1
    if args.step in ("silver", "daily"):
        run_silver(spark, args.root, args.date, args.event_name, args.bronze_format)
    if args.step in ("gold", "daily"):
        run_gold(spark, args.root, args.date)
    if args.step in ("topk", "daily"):
        # A plain top-k step may be limited to one month; the daily run reads
        # all months, as the original reports did.
        run_topk(spark, args.root, args.k, args.date if args.step == "topk" else None)
    return 0


if __name__ == "__main__":
    sys.exit(main())
