"""Incremental bronze-to-gold ingest with Structured Streaming.

The daily job, run as a stream: new bronze day folders are picked up by a
file stream, and each micro-batch is cleaned, merged into silver and
aggregated into gold for the months it touched. The stream's checkpoint
records which files were processed; the merge is idempotent, so a batch
replayed after a failure yields the same tables (effectively exactly once).
With ``available_now`` the stream processes what is there and stops, which
is how a scheduled daily run uses it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chainfold.operators.silver import quarantine
from chainfold.plans import medallion as M
from chainfold.schemas import BRONZE, LABELLED, conform
from chainfold.sinks.files import merge_months
from chainfold.sources.files import CSV_FORMAT, unescape_lines


def bronze_stream(
    spark: SparkSession, root: str, max_files_per_trigger: int | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Stream of bronze rows (fixed labelled schema, ``block_date`` from the
    folder names).

    For CSV, header names are validated against the bronze column list
    (``enforceSchema`` off), so a file with other columns fails instead of
    binding values to the wrong columns.
    """
    fields = BRONZE.fields if fmt != "csv" else [T.StructField(f.name, T.StringType()) for f in BRONZE.fields]
    schema = T.StructType([*fields, T.StructField("block_date", T.StringType())])
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_FORMAT).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(M.bronze_path(root))
    return conform(unescape_lines(rows) if fmt == "csv" else rows, LABELLED)


def process_batch(spark: SparkSession, root: str, batch: DataFrame, event_name: str = "Transfer") -> None:
    """One micro-batch: clean, merge into silver, rebuild gold of its months."""
    clean = quarantine(batch, event_name=event_name)
    merged = merge_months(clean, M.silver_path(root))
    M.build_gold(spark, root, silver_rows=merged)


def start_ingest(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    *,
    event_name: str = "Transfer",
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Start the bronze-to-gold stream; ``checkpoint`` must be on shared,
    reliable storage (it holds the stream's progress)."""
    stream = bronze_stream(spark, root, max_files_per_trigger, fmt)
    writer = (
        stream.writeStream.foreachBatch(lambda df, _epoch: process_batch(spark, root, df, event_name))
        .option("checkpointLocation", checkpoint)
        .queryName(f"chainfold_ingest_{abs(hash(root)) % 10**8}")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_ingest(spark: SparkSession, root: str, checkpoint: str, **kw) -> None:
    """Process every bronze file not yet seen, then return."""
    q = start_ingest(spark, root, checkpoint, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()

