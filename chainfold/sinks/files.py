"""File sinks: day files, partitioned tables, idempotent month merge.

Writes replace only the partitions present in the written data (dynamic
partition overwrite, set per write, not per session).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainfold.schemas import PARTITION_KEYS
from chainfold.sources.files import CSV_FORMAT, escape_lines, read_table
from chainfold.storage import discard, write_intermediate


def _writer(df: DataFrame, keys: Sequence[str], max_files: int | None, order_by: Sequence[str] = ()):
    """Writer for a table partitioned by ``keys``.

    The ``rebalance`` hint shuffles rows by the partition keys so each
    directory gets few, large files instead of one file per task and key;
    AQE sizes the shuffle partitions and splits a skewed key (a day or month
    holding a large share of the rows) over several tasks. ``max_files``
    instead caps the number of output tasks; the rows are shuffled to them,
    so the work before keeps its own parallelism.

    ``order_by`` deals and sorts the rows by ranges of the keys and these
    columns: the files of a directory follow each other in their order, with
    tight minimum and maximum statistics, and a hot directory spreads over as
    many tasks as its share of the rows. The ranges are sampled, which reads
    ``df`` once more.
    """
    if order_by:
        by = [*keys, *order_by]
        ranges = df.repartitionByRange(max_files, *by) if max_files else df.repartitionByRange(*by)
        return ranges.sortWithinPartitions(*by).write
    if max_files:
        return df.repartition(max_files).write
    return df.hint("rebalance", *keys).write


def write_days(
    df: DataFrame, root: str, *, max_files: int | None = None, fmt: str = "parquet", order_by: Sequence[str] = ()
) -> None:
    """Land rows as ``root/block_date=<day>/part-*`` files, one directory per
    day present; days not present are left untouched.

    ``block_date`` is stored in the directory name, not in the files. CSV
    files have a header and keep every string value (see ``CSV_FORMAT``).
    ``order_by`` sorts the rows of a day over its files (see ``_writer``).
    """
    if fmt == "csv":
        df = escape_lines(df)
    w = _writer(df, ["block_date"], max_files, order_by).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w = w.options(**CSV_FORMAT)
    w.partitionBy("block_date").format(fmt).save(root)


def write_day(
    df: DataFrame, root: str, block_date: str, *, max_files: int | None = None, fmt: str = "parquet"
) -> None:
    """Land one day. A row of any other day fails the write (checked inside
    the write's own tasks, so no separate pass over the data)."""
    day = F.lit(block_date).cast("date")
    guarded = df.withColumn(
        "block_date",
        F.when(
            F.col("block_date").cast("date") == day, F.col("block_date").cast("date")
        ).otherwise(F.raise_error(F.concat(F.lit("row of another day than "), F.lit(block_date)))),
    )
    write_days(guarded, root, max_files=max_files, fmt=fmt)


def write_partitions(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = PARTITION_KEYS,
    *,
    fmt: str = "parquet",
    max_files: int | None = None,
    order_by: Sequence[str] = (),
) -> None:
    """Replace the ``keys`` partitions present in ``df`` (dynamic overwrite).

    An empty ``df`` leaves the table as it is. ``order_by`` sorts the rows of
    a partition over its files (see ``_writer``).
    """
    (
        _writer(df, keys, max_files, order_by)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .format(fmt)
        .save(path)
    )


def merge_months(
    new: DataFrame,
    path: str,
    *,
    year: int | None = None,
    month: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Merge ``new`` rows into a (year, month)-partitioned table; idempotent.

    ``new`` is computed once, into an intermediate table; a row without a
    year or month, or outside ``year``/``month`` if they are given, fails
    that step, before the table is touched. Its months (few values) then
    select the existing partitions by literal predicates. Their rows are
    unioned with ``new`` by column name, de-duplicated and written back,
    replacing just those months, so a merge never loses a row. Merging the
    same rows twice changes nothing; a missing table is created.

    One job reads the old month files, merges and writes: dynamic overwrite
    stages the new files and swaps the month directories only when every
    task has finished, so a retried task still finds the old files. The
    rows returned are a fresh read of the touched months from the table,
    whose lineage no longer refers to the replaced files. A table with a
    single writer is assumed: readers may briefly see a half-replaced month.
    """
    spark = new.sparkSession
    y, m = (F.col(k).cast("int") for k in PARTITION_KEYS)
    wrong = y.isNull() | m.isNull()
    if year is not None:
        wrong = wrong | (y != int(year))
    if month is not None:
        wrong = wrong | (m != int(month))
    guarded = F.when(wrong, F.raise_error(F.concat(F.lit("row outside the months to merge: "), F.concat_ws("-", y, m)))).otherwise(y)
    batch = write_intermediate(new.withColumn("year", guarded), "merge-batch")
    months = [tuple(r) for r in batch.select(*PARTITION_KEYS).distinct().collect()]

    def touched(df: DataFrame) -> DataFrame:
        cond = F.lit(False)
        for a, b in months:
            cond = cond | ((F.col("year") == a) & (F.col("month") == b))
        return df.where(cond)

    existing = touched(read_table(spark, path, new.schema, fmt))
    if months:
        write_partitions(batch.unionByName(existing.select(*new.columns)).dropDuplicates(), path, fmt=fmt)
    discard(batch)
    return touched(read_table(spark, path, new.schema, fmt)).select(*new.columns)


def write_result_pages(df: DataFrame, path: str, rows_per_page: int = 1000) -> None:
    """Write rows as JSON result pages ``{"result": {"rows": [...], "metadata":
    {"row_count": n, "total_row_count": N}}}``, one page per line, at most
    ``rows_per_page`` rows each (bounded groups). The rows are counted first,
    so ``df`` is read twice."""
    total = df.count()
    pid = F.spark_partition_id()
    seq = F.monotonically_increasing_id()
    pages = (
        df.withColumn("__page", F.concat_ws(":", pid.cast("string"), F.floor(seq / rows_per_page).cast("string")))
        .groupBy("__page")
        .agg(F.collect_list(F.struct(*df.columns)).alias("rows"))
        .withColumn("metadata", F.struct(F.size("rows").cast("long").alias("row_count"), F.lit(total).cast("long").alias("total_row_count")))
        .select(F.struct("rows", "metadata").alias("result"))
    )
    pages.write.mode("overwrite").json(path)


def write_label_tables(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, buckets: int) -> dict[str, DataFrame]:
    """Label tables bucketed and sorted by their key, as catalog tables below ``root``; returns them by role.

    Tables with a ``blockchain`` have it and the address as key, the others
    the address. Grouping or joining by that key then needs no shuffle of the
    table. ``buckets`` should be the session's number of shuffle partitions or
    more; a daily job that writes a table once spares every later run its
    shuffle.
    """
    out = {}
    for role, df in tables.items():
        keys = [c for c in ("blockchain", "address") if c in df.columns]
        name = f"label_{role}_{uuid.uuid4().hex[:8]}"
        writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
        writer.option("path", f"{root.rstrip('/')}/{role}").saveAsTable(name)
        out[role] = spark.table(name)
    return out
