"""The daily flow: bronze day files, silver table, gold tables, top-k.

Layout under a root folder (each table partitioned as shown)::

    bronze/block_date=<day>/part-*            labelled transfers, Parquet (or header CSV)
    silver/year=<y>/month=<m>/part-*.parquet  cleaned transfers
    gold/vertical/year=<y>/month=<m>/...      weekly activity per vertical
    gold/protocol/year=<y>/month=<m>/...      weekly activity per protocol
    gold_states/<dimension>/year=<y>/month=<m>/block_date=<day>/...   each day's share of the weekly activity

Every step works on any number of days or months in one job (the
partition columns are group keys), so a backfill is one run, not a loop.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainfold.operators.gold import day_states, gold_of_states, weekly_activity
from chainfold.operators.labels import to_labelled_schema
from chainfold.operators.silver import quarantine
from chainfold.operators.topk import top_k
from chainfold.schemas import LABELLED, PARTITION_KEYS, SILVER, WEEK_KEYS, conform, gold_schema
from chainfold.sinks.files import merge_months, write_days, write_partitions
from chainfold.sources.files import CSV_FORMAT, read_csv_strings, read_table, read_table_view, unescape_lines
from chainfold.storage import discard, write_intermediate

DIMENSIONS = ("vertical", "protocol")
QUESTIONS = (
    ("vertical", "total_transactions_per_safe"),
    ("vertical", "total_amount_usd_per_safe"),
    ("protocol", "total_transactions_per_safe"),
    ("protocol", "total_amount_usd_per_safe"),
)


def bronze_path(root: str) -> str:
    return f"{root.rstrip('/')}/bronze"


def silver_path(root: str) -> str:
    return f"{root.rstrip('/')}/silver"


def gold_path(root: str, dimension: str) -> str:
    return f"{root.rstrip('/')}/gold/{dimension}"


def states_path(root: str, dimension: str) -> str:
    return f"{root.rstrip('/')}/gold_states/{dimension}"


class EmptyInput(ValueError):
    """There is no row to land; nothing was written."""


def land_bronze(
    labelled: DataFrame,
    root: str,
    *,
    day: str | None = None,
    fmt: str = "parquet",
    max_files: int | None = None,
    order_by: Sequence[str] = (),
) -> list[str]:
    """Write labelled transfers as bronze day files; returns their days.

    The rows are computed once, into an intermediate table. Rows without a
    valid ``block_date``, or of another day than ``day`` if it is given,
    raise ValueError, and no rows raise ``EmptyInput``, before anything is
    written.
    """
    batch = write_intermediate(to_labelled_schema(labelled), "bronze-batch")
    found = batch.groupBy(F.col("block_date").try_cast("date").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    days = sorted((r["day"] for r in found.collect()), key=str)
    if not days:
        raise EmptyInput("no labelled transfers to land")
    if None in days:
        raise ValueError("labelled transfers without a valid block_date")
    if day is not None and days != [day]:
        raise ValueError(f"labelled transfers of other days than {day}: {days[:5]}")
    write_days(batch, bronze_path(root), max_files=max_files, fmt=fmt, order_by=order_by)
    discard(batch)
    return days


def read_bronze(
    spark: SparkSession, root: str, block_dates: Sequence[str] | None = None, *, fmt: str = "parquet"
) -> DataFrame:
    """Bronze rows with the fixed labelled schema (``block_date`` from the
    directory names). ``block_dates`` lists the days to read (default all)."""
    base = bronze_path(root)
    paths = [f"{base}/block_date={d}" for d in block_dates] if block_dates else base
    if fmt == "csv":
        return conform(unescape_lines(read_csv_strings(spark, paths, base, CSV_FORMAT)), LABELLED, strict=True)
    rows = spark.read.format(fmt).option("basePath", base).load(paths)
    return conform(rows, LABELLED, strict=True)


def build_silver(
    spark: SparkSession,
    root: str,
    block_dates: Sequence[str] | None = None,
    *,
    event_name: str = "Transfer",
    fmt: str = "parquet",
) -> DataFrame:
    """Clean bronze days and merge them into the silver table (idempotent).
    Returns the merged rows of the months touched."""
    raw = read_bronze(spark, root, block_dates, fmt=fmt)
    clean = quarantine(raw, event_name=event_name)
    return merge_months(clean, silver_path(root))


def build_gold(
    spark: SparkSession,
    root: str,
    *,
    year: int | None = None,
    month: int | None = None,
    silver_rows: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Both gold tables from silver, for one month or (default) every month.

    Each dimension reads its own pruned columns of the silver slice; the
    year/month predicate prunes partitions at the scan. ``silver_rows``
    (whole months of silver, as ``build_silver`` returns) is used instead of
    reading the table, so only the months just merged are rebuilt.
    """
    out = {}
    for dim in DIMENSIONS:
        if silver_rows is not None:
            silver = silver_rows
        else:
            silver = spark.read.schema(SILVER).parquet(silver_path(root))
        if year is not None:
            silver = silver.where(F.col("year") == int(year))
        if month is not None:
            silver = silver.where(F.col("month") == int(month))
        gold = weekly_activity(silver, dim)
        write_partitions(gold, gold_path(root, dim))
        out[dim] = gold
    return out


_STATE_KEYS = (*PARTITION_KEYS, "block_date")


def state_schema(dimension: str) -> T.StructType:
    """Schema of a table of day states."""
    return T.StructType.fromDDL(
        f"week_of_month int, week_of_year int, {dimension} string, safe_account string, n long, amount decimal(38,2),"
        " year int, month int, block_date date"
    )


def update_gold(spark: SparkSession, root: str, days: Sequence[str]) -> None:
    """Bring both gold tables up to date after ``days`` of silver have changed.

    Each day's partial states are computed from that day's silver rows and
    replace its former states. The weeks of these days are then built from the
    states of their own days (seven at most, read by partition), and replace
    the same weeks of the gold table; the other weeks of a touched month are
    copied. A re-run of a day changes nothing. The two dimensions share no
    table but silver and are brought up to date side by side.
    """
    dates = [dt.date.fromisoformat(str(d)) for d in days]
    months = sorted({(d.year, d.month) for d in dates})
    near = sorted({d + dt.timedelta(days=k) for d in dates for k in range(-6, 7)})

    def of_months(df: DataFrame) -> DataFrame:
        cond = F.lit(False)
        for y, m in months:
            cond = cond | ((F.col("year") == y) & (F.col("month") == m))
        return df.where(cond)

    def of_weeks(df: DataFrame, weeks: Sequence[Sequence[int]]) -> Column:
        return F.struct(*PARTITION_KEYS, *WEEK_KEYS).isin([F.struct(*(F.lit(x).cast("int") for x in w)) for w in weeks])

    def update(dim: str) -> None:
        silver = of_months(read_table(spark, silver_path(root), SILVER)).where(F.col("block_date").isin(dates))
        write_partitions(day_states(silver, dim), states_path(root, dim), _STATE_KEYS)
        states = of_months(read_table(spark, states_path(root, dim), state_schema(dim)))
        weeks = [tuple(r) for r in states.where(F.col("block_date").isin(dates)).select(*PARTITION_KEYS, *WEEK_KEYS).distinct().collect()]
        if not weeks:
            return
        touched = states.where(F.col("block_date").isin(near)).where(of_weeks(states, weeks))
        fresh = gold_of_states(touched, dim)
        old = of_months(read_table(spark, gold_path(root, dim), gold_schema(dim)))
        kept = old.where(~of_weeks(old, weeks)).select(*fresh.columns)
        write_partitions(fresh.unionByName(kept), gold_path(root, dim))

    with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
        # each call takes a copy of this thread's job group and pool along
        runs = [pool.submit(inheritable_thread_target(spark)(partial(update, dim))) for dim in DIMENSIONS]
    for run in runs:
        run.result()


def read_gold(spark: SparkSession, root: str, dimension: str) -> DataFrame:
    return spark.read.schema(gold_schema(dimension)).parquet(gold_path(root, dimension))


def top_k_report(
    spark: SparkSession, root: str, k: int = 5, *, year: int | None = None, month: int | None = None
) -> dict[tuple[str, str], DataFrame]:
    """The four top-k answers, read from the gold tables (views
    ``gold_vertical`` and ``gold_protocol`` are registered)."""
    out = {}
    for dim in DIMENSIONS:
        gold = read_table_view(spark, gold_path(root, dim), f"gold_{dim}")
        for d, measure in QUESTIONS:
            if d == dim:
                out[(dim, measure)] = top_k(gold, dim, measure, k, year=year, month=month)
    return out


def top_k_table(report: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """The report as one frame: question, name, value (decimal(25,2))."""
    frames = []
    for (dim, measure), df in report.items():
        value = df.columns[1]
        frames.append(
            df.select(
                F.lit(f"{dim}:{value}").alias("question"),
                F.col(dim).alias("name"),
                F.col(value).cast("decimal(25,2)").alias("value"),
            )
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def daily_pipeline(
    spark: SparkSession,
    labelled: DataFrame,
    root: str,
    *,
    day: str | None = None,
    event_name: str = "Transfer",
    fmt: str = "parquet",
    k: int = 5,
) -> dict[tuple[str, str], DataFrame]:
    """Bronze, silver, gold and top-k for the days in ``labelled``.

    With ``day`` (the daily case) rows of any other day fail; without it
    ``labelled`` may hold many days (a backfill). Only the days landed are
    read back, and gold is rebuilt for the weeks touched, from day states. No rows raise
    ``EmptyInput`` and change nothing.
    """
    days = land_bronze(labelled, root, day=day, fmt=fmt)
    build_silver(spark, root, days, event_name=event_name, fmt=fmt)
    update_gold(spark, root, days)
    return top_k_report(spark, root, k)
