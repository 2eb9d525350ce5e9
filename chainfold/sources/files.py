"""File sources: day CSV files, landed query-result pages, lake table slices.

Every typed read binds columns by name: CSV files are read with their header
as strings and then cast to the wanted schema. All files of a read must have
the same header. Records that are no rows of it are rejected with file and
reason, or fail the read (``csv_records``).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainfold.schemas import LABELLED, OPTIONAL, conform
from chainfold.sources.csv_records import REJECTED, scan_csv
from chainfold.storage import write_intermediate

log = logging.getLogger(__name__)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty DataFrame with ``schema`` (planned JVM-side, no Python rows)."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


# How our own CSV day files are written and read: NULL and the empty string
# differ, and white space is kept.
CSV_FORMAT = {"header": True, "nullValue": "\\N", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def escape_lines(df: DataFrame) -> DataFrame:
    """String columns with backslash, line feed and carriage return written as
    ``\\b``, ``\\n`` and ``\\r``, so that a row is one line of the file."""
    return _map_strings(df, (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r")))


def unescape_lines(df: DataFrame) -> DataFrame:
    """Undo ``escape_lines``."""
    return _map_strings(df, (("\\n", "\n"), ("\\r", "\r"), ("\\b", "\\")))


def _map_strings(df: DataFrame, steps: Sequence[tuple[str, str]]) -> DataFrame:
    cols = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "string":
            for old, new in steps:
                c = F.replace(c, F.lit(old), F.lit(new))
        cols.append(c.alias(name))
    return df.select(*cols)


def read_csv_strings(
    spark: SparkSession,
    path: str | list[str],
    base_path: str | None = None,
    options: dict | None = None,
    rejects_to: str | None = None,
) -> DataFrame:
    """Header CSV files (a directory, glob or list); every column a string.

    ``base_path`` keeps ``key=value`` directories below it as partition
    columns (for example ``block_date`` of day directories). All files must
    have the same header. A record of another width or with broken quotes
    fails the read, or goes to the Parquet table ``rejects_to`` (file,
    reason, record); see ``csv_records``.
    """
    return scan_csv(spark, path, base_path=base_path, options=options).settle(rejects_to)


def read_csv_inferred(
    spark: SparkSession,
    path: str | list[str],
    base_path: str | None = None,
    options: dict | None = None,
    rejects_to: str | None = None,
) -> DataFrame:
    """Header CSV with the narrowest types that hold every value (costs one extra pass over the files)."""
    return scan_csv(spark, path, base_path=base_path, options=options, infer=True).settle(rejects_to)


def read_csv_schema(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    base_path: str | None = None,
    strict: bool = True,
    options: dict | None = None,
    rejects_to: str | None = None,
) -> DataFrame:
    """Header CSV cast to ``schema`` by column name; a column order in the
    files that differs from the schema is harmless. A column that is missing
    fails unless it is optional (``schemas.OPTIONAL``) or ``strict`` is off.
    A value that isn't of its column's type is a reject, too."""
    required = [f.name for f in schema.fields if f.name not in OPTIONAL] if strict else ()
    scan = scan_csv(spark, path, schema, base_path=base_path, options=options, required=required)
    return conform(scan.settle(rejects_to), schema, strict=strict)


class IncompletePages(ValueError):
    """The landed pages of a result hold fewer or more rows than the result has."""


_TOTALS = "row_count: long, total_row_count: long"


def envelope_schema(rows: T.StructType = LABELLED) -> T.StructType:
    """``{"result": {"rows": [ {...}, ... ], "metadata": {"row_count": n, "total_row_count": N}}}``"""
    result = T.StructType([T.StructField("rows", T.ArrayType(rows)), T.StructField("metadata", T.StructType.fromDDL(_TOTALS.replace(":", "")))])
    return T.StructType([T.StructField("result", result)])


def read_result_pages(
    spark: SparkSession,
    path: str,
    schema: T.StructType = LABELLED,
    multi_line: bool = False,
    require_totals: bool = False,
) -> DataFrame:
    """Landed query-result pages to a table of their rows.

    Each JSON document is one page ``{"result": {"rows": [...], "metadata":
    {...}}}``; pages are one per line (splittable) or, with ``multi_line``, one
    per file. The rows are flattened with ``inline`` inside the scan's stage. A
    torn page or a value of the wrong type fails the read.

    Where pages carry metadata, the set must be complete, or IncompletePages
    is raised: all name one ``total_row_count``, their ``row_count`` add up to
    it (a pass that parses the metadata only), and each page holds the rows it
    says (checked as it is read). ``require_totals`` demands metadata.
    """
    reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
    totals = reader.schema(f"result struct<metadata: struct<{_TOTALS}>>").json(path)
    seen = totals.agg(
        F.count(F.lit(1)).alias("pages"),
        F.count("result.metadata.total_row_count").alias("told"),
        F.sum("result.metadata.row_count").alias("rows"),
        F.min("result.metadata.total_row_count").alias("least"),
        F.max("result.metadata.total_row_count").alias("most"),
    ).first()
    if seen["told"] or require_totals:
        if not seen["told"] == seen["pages"] > 0 or seen["least"] != seen["most"] or seen["rows"] != seen["most"]:
            raise IncompletePages(
                f"{seen['pages']} pages ({seen['told']} with metadata) hold {seen['rows']} rows of {seen['least']} to {seen['most']}"
            )
    raw = reader.schema(envelope_schema(schema)).json(path)
    said = F.col("result.metadata.row_count")
    held = F.coalesce(F.size("result.rows"), F.lit(0))
    torn = F.raise_error(F.concat(F.lit("[INCOMPLETE_PAGES] a page says "), said, F.lit(" rows and holds "), held)).cast(T.ArrayType(schema))
    return raw.select(F.inline(F.when(F.coalesce(said, held) == held, F.col("result.rows")).otherwise(torn)))


def read_or_fallback(primary: Callable[[], DataFrame], fallback: Callable[[], DataFrame]) -> DataFrame:
    """``primary()`` unless it is missing, malformed, incomplete or holds no row; then ``fallback()``.

    The primary is read in full, into an intermediate table, so that a
    malformed record in the middle of its files selects the fallback too.
    Any other error is raised: a wrong column name, a full disk or a lost
    store is no reason to land other data.
    """
    try:
        df = write_intermediate(primary(), "primary")
        if not df.isEmpty():
            return df
    except (PySparkException, Py4JJavaError, IncompletePages) as err:
        if not (isinstance(err, IncompletePages) or is_bad_source(err)):
            raise
        log.warning("the primary source is missing or malformed, using the fallback: %s", str(err).splitlines()[0])
    return fallback()


# Error conditions (and what they contain) that mean a missing or malformed source.
_BAD_SOURCE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "MALFORMED_RECORD_IN_PARSING", "FAILED_READ_FILE.FILE_NOT_EXIST", "INCOMPLETE_PAGES")


def is_bad_source(err: BaseException) -> bool:
    """True for a missing path, a malformed record or a rejected CSV record anywhere among the causes of ``err``."""
    name = getattr(err, "getCondition", lambda: None)() or ""
    if name.startswith(_BAD_SOURCE) or (name == "USER_RAISED_EXCEPTION" and REJECTED in str(err)):
        return True
    cause = getattr(err, "java_exception", None) or getattr(err, "_origin", None)
    while cause is not None:
        text = str(cause.toString())
        if any(f"[{c}" in text for c in _BAD_SOURCE) or "FileNotFoundException" in text or ("[USER_RAISED_EXCEPTION]" in text and REJECTED in text):
            return True
        cause = cause.getCause()
    return False


def _is_missing(err: AnalysisException) -> bool:
    cond = getattr(err, "getCondition", None) or getattr(err, "getErrorClass", None)
    name = cond() if cond else None
    return name == "PATH_NOT_FOUND" or "Path does not exist" in str(err)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """A lake table. With ``schema`` the files are read with it (no schema
    inference, so a table that holds no file yet reads as empty) and a
    missing path gives an empty frame of ``schema``."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as err:
        if schema is not None and _is_missing(err):
            return empty_frame(spark, schema)
        raise


def read_month(
    spark: SparkSession,
    path: str,
    year: int,
    month: int,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """One (year, month) slice of a table partitioned by year and month.

    The literal predicate on the partition columns is applied as a partition
    filter, so only that month's files are listed and read. A missing table
    gives an empty frame of ``schema``.
    """
    df = read_table(spark, path, schema, fmt)
    return df.where((F.col("year") == F.lit(int(year))) & (F.col("month") == F.lit(int(month))))


def read_table_view(spark: SparkSession, path: str, view: str, fmt: str = "parquet") -> DataFrame:
    """Read a whole table and register it as temporary view ``view``."""
    df = spark.read.format(fmt).load(path)
    df.createOrReplaceTempView(view)
    return df
