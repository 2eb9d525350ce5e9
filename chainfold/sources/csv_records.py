"""Header CSV files with a channel for rejected records.

Spark's own reader fills short rows with NULL, drops surplus values and turns
bad numbers into NULL. Here every record is kept or rejected, with file and
reason: wrong column count, broken quotes, or a value that isn't of its
column's type. Records in = rows + rejects.

How it runs: the files are read as lines (splittable). One aggregation gives
for each file its header line and whether a line ends inside a quoted value.
Only files that have such lines are dealt by file, sorted and stitched, so
that a quoted value with line breaks is one record; a quote that never closes
into a record of the right width rejects its own line alone. Everything else
stays in the scan's stage: a linear pattern for the record's form,
``from_csv`` for its values.

The first line of every file is its header, and all must be equal; later
lines equal to it are headers too. Empty lines are no records. Line ends
inside a quoted value become ``\\n``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainfold.operators.joins import broadcast_if_bounded
from chainfold.storage import write_intermediate

WRONG_WIDTH = "wrong column count"
BROKEN_QUOTES = "broken quotes"
BAD_VALUE = "bad value in "
#: Start of the error that a rejected record raises where rejects aren't kept.
REJECTED = "malformed CSV record: "
#: Lines and characters within which a quoted value must close.
MOST_LINES = 1000
MOST_CHARS = 16 << 20
# Types tried for an inferred column, narrowest first.
INFERRED = ("int", "bigint", "double", "date", "timestamp")


class OtherHeader(ValueError):
    """Files of one read have different headers."""


@dataclass
class _Form:
    """Patterns of a record; possessive, so matching is linear and needs no stack."""

    field: str
    opened: str

    @classmethod
    def of(cls, options: Mapping[str, object], doubled: bool = True) -> _Form:
        """``doubled``: a quote inside a quoted value may be doubled as well as escaped."""
        sep, quote, escape = (str(options.get(k, d)) for k, d in (("sep", ","), ("quote", '"'), ("escape", "\\")))
        s, q, e = (re.escape(c) for c in (sep, quote, escape))
        pad = r"[ \t]*+" if str(options.get("ignoreLeadingWhiteSpace", False)).lower() == "true" else ""
        special = f"{q}{q}" if e == q else f"{q}{q}|{e}[\\s\\S]" if doubled else f"{e}[\\s\\S]"
        plain = f"[^{q}]*+" if e == q else f"[^{q}{e}]*+"
        inner = f"{plain}(?:(?:{special}){plain})*+"
        tail = "[ \\t]*+" if str(options.get("ignoreTrailingWhiteSpace", False)).lower() == "true" else ""
        field = f"(?:{pad}{q}{inner}{q}{tail}|(?!{pad}{q})[^{s}\\r\\n]*+)"
        return cls(field, f"^(?:{field}{s})*+{pad}{q}{inner}(?:{e})?" if e != q else f"^(?:{field}{s})*+{pad}{q}{inner}")

    def record(self, sep: str, width: int | None = None) -> str:
        return f"^{self.field}(?:{re.escape(sep)}{self.field})" + ("*+" if width is None else f"{{{width - 1}}}+")


@dataclass
class CsvScan:
    """``rows`` (typed, partition columns first), ``rejects`` (file, reason, record) and ``checked`` (rows, failing at a reject)."""

    parsed: DataFrame
    columns: list[str]

    @property
    def rows(self) -> DataFrame:
        return self.parsed.where(F.col("__reason").isNull()).select(*self.columns)

    @property
    def rejects(self) -> DataFrame:
        return self.parsed.where(F.col("__reason").isNotNull()).select(
            F.col("__file").alias("file"), F.col("__reason").alias("reason"), F.col("__record").alias("record")
        )

    @property
    def checked(self) -> DataFrame:
        text = F.concat(F.lit(REJECTED), F.col("__reason"), F.lit(" in "), F.col("__file"), F.lit(": "), F.substring("__record", 1, 200))
        fine = F.when(F.col("__reason").isNull(), F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))
        return self.parsed.where(fine).select(*self.columns)

    def settle(self, rejects_to: str | None) -> DataFrame:
        """The rows; rejects are written as Parquet to ``rejects_to``, or fail the read if it is None."""
        if rejects_to is None:
            return self.checked
        self.rejects.write.mode("append").parquet(rejects_to)
        return self.rows


def _stitched(lines: DataFrame, keep: Sequence[str], form: _Form, sep: str, quote: str, width: int) -> DataFrame:
    """Records of files in which quoted values hold line breaks (``lines`` has __file, __start, __seq, value)."""
    opened, whole = re.compile(form.opened + r"\Z"), re.compile(form.record(sep, width) + r"\Z")
    ordered = lines.repartition("__file").sortWithinPartitions("__file", "__start", "__seq").select("__file", *keep, "value")
    names = ordered.columns

    def records(texts: list[str], held: list[str], at_end: bool) -> Iterator[str]:
        """Records of the lines so far; ``held`` keeps the lines of one that is still open."""
        todo = list(reversed(texts))
        while todo or (at_end and held):
            if not todo:
                # never closed: its first line is a record of its own
                yield held[0]
                todo = held[:0:-1]
                held.clear()
                continue
            line = todo.pop()
            if not held:
                if quote in line and opened.match(line):
                    held.append(line)
                elif line.strip():
                    yield line
                continue
            held.append(line)
            text = "\n".join(held) if quote in line or len(held) > MOST_LINES else None
            if text is not None and (len(held) > MOST_LINES or len(text) > MOST_CHARS or not opened.match(text)):
                if whole.match(text) and len(held) <= MOST_LINES:
                    yield text
                else:
                    yield held[0]
                    todo += held[:0:-1]
                held.clear()

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        file, parts = None, None

        def out(head: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            columns = [pa.array([c[0].as_py()] * len(texts), c.type) for c in head.columns]
            return pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names)

        for batch in batches:
            files = batch.column(0).to_pylist()
            cuts = [0, *(i for i in range(1, len(files)) if files[i] != files[i - 1]), len(files)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if files[a] != file and held:
                    yield out(parts, list(records([], held, True)))
                file, parts = files[a], batch.slice(a, 1).select(names[:-1])
                yield out(parts, list(records(batch.column(len(names) - 1).slice(a, b - a).to_pylist(), held, False)))
        if held:
            yield out(parts, list(records([], held, True)))

    return ordered.mapInArrow(stitch, ordered.schema)


def _inferred(records: DataFrame, names: Sequence[str]) -> T.StructType:
    """The narrowest type that holds every value of each column."""
    checks = []
    for i, n in enumerate(names):
        value = F.col(f"__raw.`{n}`")
        some = value.isNotNull() & (value != "")
        checks.append(F.max(some).alias(f"s{i}"))
        checks += [F.max(some & value.try_cast(t).isNull()).alias(f"{t}{i}") for t in INFERRED]
        checks.append(F.max(some & ~F.lower(value).isin("true", "false")).alias(f"boolean{i}"))
    seen = records.where(F.col("__reason").isNull()).agg(*checks).first()
    kinds = []
    for i in range(len(names)):
        fits = [t for t in (*INFERRED, "boolean") if not seen[f"{t}{i}"]] if seen[f"s{i}"] else []
        kinds.append(fits[0] if fits else "string")
    return T.StructType([T.StructField(n, T.DataType.fromDDL(k)) for n, k in zip(names, kinds, strict=True)])


def typed(raw: Column, field: T.StructField) -> tuple[Column, Column]:
    """(value, reason to reject it or NULL) of a string read for ``field``; the empty string is no number and no date, but NULL."""
    if isinstance(field.dataType, T.StringType):
        return raw, F.lit(None).cast("string")
    value = raw.try_cast(field.dataType)
    bad = raw.isNotNull() & (F.trim(raw) != "") & value.isNull()
    return value, F.when(bad, F.lit(BAD_VALUE + field.name))


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    *,
    base_path: str | None = None,
    options: Mapping[str, object] | None = None,
    infer: bool = False,
    required: Sequence[str] = (),
) -> CsvScan:
    """Read header CSV files; every record is a row or a reject.

    Without ``schema`` all columns are strings, or of the narrowest type that
    fits with ``infer``. ``schema`` gives types by column name; columns of the
    files that it doesn't name stay strings, and names that the files lack are
    left to the caller, but for the ``required`` ones. ``key=value`` directories below ``base_path`` become
    columns.
    """
    opts = {"header": True, **(options or {})}
    reader = spark.read.options(**{**opts, "inferSchema": False})
    text = spark.read
    if base_path:
        reader, text = reader.option("basePath", base_path), text.option("basePath", base_path)
    found = reader.csv(path)
    files = text.text(path)
    parts = [c for c in files.columns if c != "value"]
    names = [c for c in found.columns if c not in parts]
    if missing := [c for c in required if c not in found.columns]:
        raise ValueError(f"columns {missing} are missing; have {sorted(found.columns)}")
    if not names:
        return CsvScan(
            files.limit(0).select(
                *[F.lit("").alias(c) for c in ("__file", "__record")], F.lit(None).cast("string").alias("__reason"), *parts
            ),
            parts,
        )
    sep, quote = str(opts.get("sep", ",")), str(opts.get("quote", '"'))
    form = _Form.of(opts)
    lines = files.select(
        "value", *parts, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start")
    ).withColumn("__seq", F.monotonically_increasing_id())
    per_file = write_intermediate(
        lines.groupBy("__file").agg(
            F.min_by("value", F.struct("__start", "__seq")).alias("header"),
            F.max(F.col("value").contains(quote) & F.col("value").rlike(form.opened + r"\z")).alias("opened"),
        ),
        "csv-files",
    )
    first = per_file.agg(F.min("header"), F.max("header"), F.max("opened")).first()
    if first[0] != first[1]:
        raise OtherHeader(f"files have different headers: {first[0]!r}, {first[1]!r}")
    if first[2]:
        with_breaks, _ = broadcast_if_bounded(per_file.where("opened").select("__file", F.col("opened").alias("__stitch")))
        told = lines.join(with_breaks, "__file", "left")
        stitched = _stitched(told.where("__stitch"), parts, form, sep, quote, len(names))
        records = told.select("__file", *parts, "value", "__stitch").unionByName(stitched.withColumn("__stitch", F.lit(None).cast("boolean")))
    else:
        records = lines.select("__file", *parts, "value", F.lit(None).cast("boolean").alias("__stitch"))
    # part of the reason, too: a check that fails must not run before these rows are gone
    no_record = F.col("__stitch").isNotNull() | (F.trim("value") == "") | (F.col("value") == first[0])
    records = records.where(~no_record)
    reason = (
        F.when(no_record | F.col("value").rlike(form.record(sep, len(names)) + r"\z"), F.lit(None).cast("string"))
        .when(F.col("value").rlike(form.record(sep) + r"\z"), F.lit(WRONG_WIDTH))
        .otherwise(F.lit(BROKEN_QUOTES))
    )
    strings = T.StructType([T.StructField(n, T.StringType()) for n in names])
    parse = {k: str(v) for k, v in opts.items() if k not in ("header", "inferSchema")} | {"multiLine": "true", "mode": "PERMISSIVE"}
    # Spark's parser knows one way to write a quote inside a quoted value
    as_given = ~F.col("value").contains(quote * 2) | F.col("value").rlike(_Form.of(opts, doubled=False).record(sep) + r"\z")
    raw = F.when(as_given, F.from_csv("value", strings.toDDL(), parse)).otherwise(F.from_csv("value", strings.toDDL(), parse | {"escape": quote}))
    parsed = records.select("__file", F.col("value").alias("__record"), *parts, reason.alias("__reason"), raw.alias("__raw"))
    if infer:
        schema = _inferred(parsed, names)
    kinds = {f.name: f for f in schema.fields} if schema is not None else {}
    values, reasons = [], [F.col("__reason")]
    for n in names:
        value, bad = typed(F.col(f"__raw.`{n}`"), kinds.get(n, strings[n]))
        values.append(value.alias(n))
        reasons.append(bad)
    parsed = parsed.select("__file", "__record", F.coalesce(*reasons).alias("__reason"), *parts, *values)
    return CsvScan(parsed, [f"`{c}`" for c in [*names, *parts]])
