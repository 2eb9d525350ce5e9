"""Gold by day states, counted rejects, fingerprints, ordered landing."""

from __future__ import annotations

import glob
import threading

import pytest
from pyspark.sql import functions as F

from chainfold.operators.compare import differing_buckets, same_rows
from chainfold.operators.gold import weekly_activity
from chainfold.operators.silver import REASONS, quarantine, quarantine_counted
from chainfold.plans import medallion as M
from chainfold.plans.testdata import event_transfers
from chainfold.schemas import SILVER
from chainfold.session import scratch_dir
from chainfold.sinks.files import write_days, write_partitions
from chainfold.sources.files import read_table
from chainfold.storage import shuffle_cleanup
from tests.conftest import SMOKE_DIR

COLUMNS = "tx_hash string, event_name string, vertical string, protocol string, amount_usd double, token_category string, block_date string"


def transfers(spark, rows):
    """Rows of (account, vertical, amount, day)."""
    return spark.createDataFrame([(t, "Transfer", v, "p", a, "erc20", d) for t, v, a, d in rows], COLUMNS)


def land(spark, root, df):
    days = M.land_bronze(df, root)
    M.build_silver(spark, root, days)
    M.update_gold(spark, root, days)
    return days


def gold_is_whole(spark, root):
    silver = read_table(spark, M.silver_path(root), SILVER)
    return all(same_rows(M.read_gold(spark, root, dim), weekly_activity(silver, dim)).isEmpty() for dim in M.DIMENSIONS)


DAYS = ["2024-01-28", "2024-01-31", "2024-02-01", "2024-02-03", "2024-02-04", "2024-02-29", "2024-12-30", "2025-01-01"]


def test_days_in_any_order_and_again(spark):
    root = scratch_dir(spark, "t-days")
    rows = [(f"a{i % 5}", f"v{i % 3}", 1.0 + i, DAYS[i % 8]) for i in range(64)] + [("big", "v0", 9e12, d) for d in DAYS[2:5]]
    df = transfers(spark, rows)
    for part in (DAYS[2:3], DAYS[:2] + DAYS[6:], DAYS[2:6], DAYS[3:4]):
        land(spark, root, df.where(F.col("block_date").isin(part)))
        assert gold_is_whole(spark, root)
    # the overflowing sum of a week is NULL, as in a rebuild
    assert M.read_gold(spark, root, "vertical").where("safe_account = 'big' AND total_amount_usd_per_safe IS NULL").count() == 1
    # a day whose rows are all rejected changes nothing
    before = M.read_gold(spark, root, "vertical").collect()
    land(spark, root, transfers(spark, [("x", "v0", -1.0, "2024-02-02")]))
    assert same_rows(M.read_gold(spark, root, "vertical"), spark.createDataFrame(before, M.gold_schema("vertical"))).isEmpty()


def test_a_day_reads_its_weeks_only(spark):
    """State files of other weeks and silver files of other months aren't even readable."""
    root = scratch_dir(spark, "t-reads")
    land(spark, root, transfers(spark, [("a", "v", 1.0, "2024-03-04"), ("b", "v", 2.0, "2024-03-20"), ("c", "v", 3.0, "2024-02-07")]))
    local = root.removeprefix("file:")
    others = glob.glob(f"{local}/gold_states/*/*/*/block_date=2024-03-04/*.parquet") + glob.glob(f"{local}/gold_states/*/*/month=2/*/*.parquet")
    others += glob.glob(f"{local}/silver/*/month=2/*.parquet") + glob.glob(f"{local}/gold/*/*/month=2/*.parquet")
    assert len(others) >= 7
    kept = {}
    for name in others:
        with open(name, "rb+") as f:
            kept[name] = f.read()
            f.seek(0)
            f.write(b"no parquet file")
    land(spark, root, transfers(spark, [("b", "v", 5.0, "2024-03-21")]))
    for name, data in kept.items():
        with open(name, "wb") as f:
            f.write(data)
    assert gold_is_whole(spark, root)


def test_kept_and_rejected_rows_make_the_input(spark):
    ev = event_transfers(spark, SMOKE_DIR)
    clean, accounting = quarantine_counted(ev)
    assert same_rows(clean, quarantine(ev)).isEmpty()
    clean, accounting = quarantine_counted(ev)
    n = clean.count()
    counts = accounting.counts
    assert sum(counts.values()) == ev.count() and counts["kept"] == n and all(counts[r] > 0 for r in (*REASONS, "duplicate"))
    odd = transfers(spark, [("a", "v", 1.0, "2024-01-01"), ("a", "v", None, "2024-01-01"), (None, "v", 1.0, "2024-01-01")])
    odd = odd.unionByName(odd.withColumn("event_name", F.lit(None).cast("string")))
    clean, accounting = quarantine_counted(odd)
    clean.collect()
    assert accounting.counts == dict(zip((*REASONS, "duplicate", "kept"), (3, 1, 1, 0, 1), strict=True))


def test_fingerprints(spark):
    a = spark.range(5000).select((F.col("id") % 4000).alias("id"), F.when(F.col("id") % 7 == 0, None).otherwise(F.lit(0.5)).alias("x"), F.array("id").alias("s"))
    shuffled = a.repartition(7).select("s", "x", "id")
    same = same_rows(a, shuffled)
    assert same.isEmpty() and same.columns == ["side", "id", "x", "s"]
    assert "Exchange" not in same._jdf.queryExecution().executedPlan().toString()
    more = a.unionByName(a.where("id = 17").limit(1))
    assert [tuple(r)[:2] for r in same_rows(more, a).collect()] == [("actual_only", 17)]
    assert [tuple(r)[:2] for r in same_rows(a, more).collect()] == [("expected_only", 17)]
    assert len(differing_buckets(a, more)) == 1
    assert {r["side"] for r in same_rows(a, a.withColumn("x", F.lit(1.0))).collect()} == {"actual_only", "expected_only"}
    assert same_rows(a, a.withColumn("id", F.col("id").cast("int"))).isEmpty()
    assert same_rows(a.limit(0), a.limit(0)).isEmpty() and same_rows(a.limit(0), a.limit(3)).count() == 3


@pytest.mark.parametrize("partitioned", [False, True])
def test_a_hot_day_lies_in_order_in_several_files(spark, partitioned):
    path = scratch_dir(spark, "t-order")
    day = F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise(F.date_add(F.lit("2024-01-02"), (F.col("id") % 40).cast("int")).cast("string"))
    df = spark.range(60_000).select(F.reverse(F.format_string("%06d", "id")).alias("k"), day.cast("date").alias("block_date"), F.lit(1).alias("month"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        if partitioned:
            write_partitions(df, path, ["block_date"], order_by=["k"])
        else:
            write_days(df, path, order_by=["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = spark.read.parquet(path).select("block_date", "k", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    files = rows.groupBy("block_date", "file").agg(F.min("k").alias("first"), F.max("k").alias("last"), F.sort_array(F.collect_list(F.struct("at", "k"))).alias("ks"))
    by_day: dict = {}
    for r in files.orderBy("file").collect():
        ks = [x["k"] for x in r["ks"]]
        assert ks == sorted(ks)
        by_day.setdefault(str(r["block_date"]), []).append((r["first"], r["last"]))
    assert len(by_day["2024-01-01"]) >= 3 and sum(len(v) for v in by_day.values()) <= len(by_day) + 10
    for ranges in by_day.values():
        assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_both_dimensions_are_updated_side_by_side(spark, monkeypatch):
    together, states = threading.Barrier(len(M.DIMENSIONS)), M.day_states

    def both_here(*args):
        together.wait(30)
        return states(*args)

    monkeypatch.setattr(M, "day_states", both_here)
    root = scratch_dir(spark, "root")
    land(spark, root, transfers(spark, [("a", "v", 1.0, "2024-01-02"), ("a", "w", 2.0, "2024-01-03")]))
    assert gold_is_whole(spark, root)


@pytest.mark.parametrize("before", [None, "false"])
def test_cleanup_of_overlapping_writes_puts_the_setting_back(spark, before):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    if before:
        spark.conf.set(name, before)
    first, second = shuffle_cleanup(spark), shuffle_cleanup(spark)
    try:
        value = spark.conf.get(name, None)
        first.__enter__()
        second.__enter__()
        first.__exit__(None, None, None)
        assert spark.conf.get(name) == "true"
        second.__exit__(None, None, None)
        assert spark.conf.get(name, None) == value
    finally:
        spark.conf.unset(name)
