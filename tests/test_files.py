"""File sources and sinks: by-name binding, fallbacks, idempotent merges."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainfold.operators.compare import same_rows
from chainfold.operators.silver import quarantine
from chainfold.plans import medallion as M
from chainfold.schemas import LABELLED, SILVER
from chainfold.session import scratch_dir
from chainfold.sinks.files import merge_months, write_day, write_days, write_partitions, write_result_pages
from chainfold.sources.files import (
    IncompletePages,
    empty_frame,
    read_csv_inferred,
    read_csv_schema,
    read_csv_strings,
    read_month,
    read_or_fallback,
    read_result_pages,
    read_table,
)
from chainfold.sources.tables import literal_table, number_range
from tests.conftest import rows

SCHEMA = T.StructType(
    [
        T.StructField("tx_hash", T.StringType()),
        T.StructField("amount_usd", T.DoubleType()),
        T.StructField("block_date", T.DateType()),
    ]
)


def test_csv_binds_by_name(spark):
    root = scratch_dir(spark, "t-csv")
    df = spark.createDataFrame([("0.75", "a", "2024-11-23"), ("12", "b", "2024-11-24")], "amount_usd string, tx_hash string, block_date string")
    write_days(df.withColumn("block_date", F.col("block_date").cast("date")), root, fmt="csv")
    back = read_csv_schema(spark, root, SCHEMA, base_path=root)
    assert rows(back) == [("a", 0.75, dt.date(2024, 11, 23)), ("b", 12.0, dt.date(2024, 11, 24))]


def test_write_day_rejects_other_days(spark):
    root = scratch_dir(spark, "t-day")
    df = spark.createDataFrame([("a", "2024-11-23"), ("b", "2024-11-24")], "tx_hash string, block_date string")
    with pytest.raises(Exception, match="another day"):
        write_day(df, root, "2024-11-23")
    write_day(df.where("tx_hash = 'a'"), root, "2024-11-23")
    assert spark.read.parquet(root).count() == 1


def test_a_file_with_another_header_fails(spark):
    root = scratch_dir(spark, "t-order")
    spark.createDataFrame([("h1", "v", 1.5)], "tx_hash string, vertical string, amount_usd double").coalesce(1).write.option("header", True).csv(root)
    spark.createDataFrame([(2.5, "h2", "v")], "amount_usd double, tx_hash string, vertical string").coalesce(1).write.mode("append").option("header", True).csv(root)
    for read in (read_csv_strings, read_csv_inferred):
        with pytest.raises(Exception, match="(?i)header"):
            read(spark, root).collect()
    with pytest.raises(ValueError, match="missing"):
        read_csv_schema(spark, root, T.StructType([T.StructField("protocol", T.StringType())]))


ODD = ["line\nfeed", "car\rriage", "  spaces ", "", None, 'quo"te', "com,ma", "back\\slash\\n", "\\N", "\\b", "é\u2028x", "\\"]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_bronze_round_trip_keeps_every_value(spark, fmt):
    root = scratch_dir(spark, "t-odd")
    data = [(f"h{i}", v, v, float(i), "2024-11-23") for i, v in enumerate(ODD)]
    df = spark.createDataFrame(data, "tx_hash string, vertical string, symbol string, amount_usd double, block_date string")
    assert M.land_bronze(df, root, fmt=fmt) == ["2024-11-23"]
    back = M.read_bronze(spark, root, fmt=fmt)
    assert rows(back.select("tx_hash", "vertical", "symbol", "amount_usd")) == sorted([(a, b, c, d) for a, b, c, d, _ in data], key=repr)


def test_landing_checks_its_days(spark):
    root = scratch_dir(spark, "t-land")
    df = spark.createDataFrame([("a", "2024-11-23"), ("b", "2024-11-24")], "tx_hash string, block_date string")
    with pytest.raises(ValueError, match="other days"):
        M.land_bronze(df, root, day="2024-11-23")
    with pytest.raises(ValueError, match="valid block_date"):
        M.land_bronze(df.withColumn("block_date", F.lit("soon")), root)
    with pytest.raises(M.EmptyInput):
        M.daily_pipeline(spark, df.limit(0), root)
    assert read_table(spark, M.bronze_path(root), LABELLED).count() == 0


def test_torn_and_malformed_pages_fail(spark, tmp_path):
    for name, line in {"torn": '{"result": {"rows": [{"tx_hash": "a", "amount_usd": 1.0}', "number": '{"result": {"rows": [{"tx_hash": "a", "amount_usd": "x"}]}}'}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "page.json").write_text('{"result": {"rows": [{"tx_hash": "b", "amount_usd": 2.0}]}}\n' + line + "\n")
        path = f"file://{tmp_path}/{name}"
        with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
            read_result_pages(spark, path).collect()
        # An error in the middle of the primary source selects the fallback.
        assert read_or_fallback(lambda path=path: read_result_pages(spark, path), lambda: spark.range(3)).count() == 3


def test_pages_and_fallback(spark):
    path = scratch_dir(spark, "t-pages")
    src = spark.range(2500).select(
        F.col("id").cast("string").alias("tx_hash"), (F.col("id") / 4).alias("amount_usd")
    )
    from chainfold.schemas import conform

    write_result_pages(conform(src, LABELLED), path, rows_per_page=100)
    back = read_result_pages(spark, path, LABELLED)
    assert back.count() == 2500 and back.agg(F.sum("amount_usd")).first()[0] == src.agg(F.sum("amount_usd")).first()[0]
    missing = scratch_dir(spark, "t-missing")
    empty = scratch_dir(spark, "t-empty")
    spark.range(0).write.parquet(empty)
    used = read_or_fallback(lambda: spark.read.parquet(missing), lambda: src)
    assert used.count() == 2500
    used = read_or_fallback(lambda: spark.read.parquet(empty), lambda: src.limit(3))
    assert used.count() == 3
    assert read_or_fallback(lambda: src.limit(1), lambda: src).count() == 1


def test_missing_table_is_empty(spark):
    missing = scratch_dir(spark, "t-none")
    df = read_month(spark, missing, 2024, 1, SILVER)
    assert df.count() == 0 and df.schema == read_month(spark, missing, 2024, 2, SILVER).schema
    assert empty_frame(spark, SILVER).columns == [f.name for f in SILVER.fields]
    with pytest.raises(Exception):
        read_table(spark, missing)  # no schema: the error is raised


def test_partition_overwrite_keeps_other_months(spark):
    path = scratch_dir(spark, "t-part")
    df = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "v int, year int, month int")
    write_partitions(df, path)
    write_partitions(spark.createDataFrame([(9, 2024, 2)], "v int, year int, month int"), path)
    assert rows(read_table(spark, path)) == [(1, 2024, 1), (9, 2024, 2)]
    # Pruned read of one month.
    m = read_month(spark, path, 2024, 2)
    assert rows(m) == [(9, 2024, 2)]
    assert "PartitionFilters: [isnotnull(year" in m._jdf.queryExecution().executedPlan().toString()


def _silver_rows(spark, data):
    df = spark.createDataFrame(
        data, "tx_hash string, amount_usd double, block_date string"
    ).select(
        "tx_hash",
        F.lit("Transfer").alias("event_name"),
        F.lit("v").alias("vertical"),
        F.lit("p").alias("protocol"),
        "amount_usd",
        F.lit("erc20").alias("token_category"),
        "block_date",
    )
    return quarantine(df)


def test_merge_guards_its_months(spark):
    path = scratch_dir(spark, "t-guard")
    jan = _silver_rows(spark, [(f"j{i}", 1.0, "2024-01-05") for i in range(6)])
    feb = _silver_rows(spark, [(f"f{i}", 1.0, "2024-02-05") for i in range(6)])
    merge_months(jan.unionByName(feb), path)
    mixed = jan.limit(3).unionByName(feb.limit(2))
    with pytest.raises(Exception, match="outside the months"):
        merge_months(mixed, path, year=2024, month=1)
    with pytest.raises(Exception, match="outside the months"):
        merge_months(jan.withColumn("month", F.lit(None).cast("int")), path)
    merge_months(mixed, path)
    merge_months(feb.limit(0), path)
    assert read_table(spark, path, SILVER).count() == 12


ROW = st.tuples(
    st.sampled_from(["a", "b", "c"]),
    st.sampled_from([1.0, 2.5, 7.25]),
    st.sampled_from(["2024-01-31", "2024-02-01", "2024-02-29", "2024-03-01"]),
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, max_size=8), st.lists(ROW, max_size=8))
def test_merge_is_idempotent_and_order_free(spark, first, second):
    p1, p2 = scratch_dir(spark, "t-m1"), scratch_dir(spark, "t-m2")
    a, b = _silver_rows(spark, first), _silver_rows(spark, second)
    for batch in (a, b, a):
        merge_months(batch, p1)
    for batch in (b, a):
        merge_months(batch, p2)
    expected = a.unionByName(b).distinct()
    got1 = read_table(spark, p1, SILVER).select(*expected.columns)
    got2 = read_table(spark, p2, SILVER).select(*expected.columns)
    assert same_rows(got1, expected).count() == 0
    assert same_rows(got2, expected).count() == 0


def test_literal_tables(spark):
    s = T.StructType([T.StructField("id", T.FloatType()), T.StructField("name", T.StringType())])
    df = literal_table(spark, [(10.0, "x"), (20.1, "y"), (20.2, "z")], s)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in s] and df.count() == 3
    # Third smallest after truncation to int, with truncation duplicates kept.
    third = df.select(F.col("id").cast("int").alias("id")).orderBy("id").offset(2).limit(1).first()
    assert third.id == 20
    assert number_range(spark, 200).count() == 200


def test_medallion_and_stream_agree(spark):
    from tests.conftest import SMOKE_DIR
    from chainfold.plans.testdata import event_transfers
    from chainfold.streaming.ingest import run_ingest

    ev = event_transfers(spark, SMOKE_DIR)
    batch_root = scratch_dir(spark, "t-batch")
    report = M.daily_pipeline(spark, ev, batch_root)
    stream_root = scratch_dir(spark, "t-stream")
    ckpt = scratch_dir(spark, "t-ckpt")
    early = F.dayofmonth("block_date") <= 10
    M.land_bronze(ev.where(early), stream_root)
    run_ingest(spark, stream_root, ckpt)
    M.land_bronze(ev.where(~early), stream_root)
    run_ingest(spark, stream_root, ckpt)
    for dim in M.DIMENSIONS:
        assert same_rows(M.read_gold(spark, batch_root, dim), M.read_gold(spark, stream_root, dim)).count() == 0
    assert same_rows(
        read_table(spark, M.silver_path(batch_root)), read_table(spark, M.silver_path(stream_root))
    ).count() == 0
    assert set(report) == set(M.QUESTIONS)
    assert M.top_k_table(report).count() > 0

    # Progress lost (a new checkpoint folder): every file is replayed, and
    # the idempotent merge leaves silver and gold as they were.
    before = read_table(spark, M.silver_path(stream_root)).collect()
    run_ingest(spark, stream_root, scratch_dir(spark, "t-ckpt-lost"))
    after = read_table(spark, M.silver_path(stream_root))
    assert same_rows(after, spark.createDataFrame(before, after.schema)).count() == 0
    for dim in M.DIMENSIONS:
        assert same_rows(M.read_gold(spark, batch_root, dim), M.read_gold(spark, stream_root, dim)).count() == 0


def test_page_sets_are_complete(spark, tmp_path):
    def page(rows, said=None, total=None):
        meta = "" if total is None else f', "metadata": {{"row_count": {len(rows) if said is None else said}, "total_row_count": {total}}}'
        return '{"result": {"rows": [' + ", ".join(f'{{"tx_hash": "{r}"}}' for r in rows) + "]" + meta + "}}"

    def read(*pages, **kw):
        folder = tmp_path / str(len(list(tmp_path.iterdir())))
        folder.mkdir()
        for i, p in enumerate(pages):
            (folder / f"{i}.json").write_text(p + "\n")
        return read_result_pages(spark, f"file://{folder}", **kw)

    assert read(page("ab", total=3), page("c", total=3)).count() == 3
    assert read(page("ab"), page("c")).count() == 3
    assert read(page("", total=0)).count() == 0
    for pages in ([page("ab", total=3)], [page("ab", total=3), page("c", total=4)], [page("ab", total=3), page("c")], [page("ab", total=2)] * 2):
        with pytest.raises(IncompletePages):
            read(*pages)
    with pytest.raises(IncompletePages):
        read(page("ab"), require_totals=True)
    with pytest.raises(Exception, match="says 3 rows and holds 2"):
        read(page("ab", said=3, total=3)).collect()
    assert read_or_fallback(lambda: read(page("ab", total=3)), lambda: spark.range(7)).count() == 7
    assert read_or_fallback(lambda: read(page("ab", said=3, total=3)), lambda: spark.range(7)).count() == 7
