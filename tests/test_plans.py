"""Plan shape guards: pushdown, pruning, join strategies, no whole-group tasks."""

from __future__ import annotations

import contextlib
import datetime as dt
import io

from chainfold.operators import labels as L
from chainfold.operators.gold import weekly_activity
from chainfold.operators.joins import materialize
from chainfold.operators.silver import quarantine
from chainfold.operators.topk import top_k
from chainfold.plans.testdata import event_transfers, label_inputs
from chainfold.schemas import SILVER
from chainfold.session import scratch_dir
from chainfold.sinks.files import write_partitions
from tests.conftest import SMOKE_DIR


def _plan(df) -> str:
    df.collect()  # final adaptive plan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _silver_table(spark):
    path = scratch_dir(spark, "t-plan-silver")
    write_partitions(quarantine(event_transfers(spark, SMOKE_DIR)), path)
    return spark.read.schema(SILVER).parquet(path).where("year = 2024 AND month = 1")


def test_gold_plan(spark):
    plan = _plan(weekly_activity(_silver_table(spark), "vertical"))
    assert "PartitionFilters: [isnotnull(year" in plan
    # Only the columns gold needs are read from silver.
    assert "ReadSchema: struct<tx_hash:string,vertical:string,amount_usd:double,week_of_year:int,week_of_month:int>" in plan
    assert "BroadcastHashJoin Inner" in plan
    assert "Window" not in plan and "CartesianProduct" not in plan


def test_top_k_plan(spark):
    plan = _plan(top_k(weekly_activity(_silver_table(spark), "protocol"), "protocol", "total_transactions_per_safe"))
    assert "TakeOrderedAndProject" in plan


def test_label_plan_has_no_pairwise_joins(spark):
    inp = label_inputs(spark, SMOKE_DIR)
    for df in (L.label_transfers(inp), L.label_transfers(inp, max_broadcast_rows=0, materialize_steps=False)):
        plan = _plan(df)
        assert "BroadcastNestedLoopJoin" not in plan
        assert "CartesianProduct" not in plan
        # Label tables are filtered where they are read (filters pushed to the scan).
        assert "PushedFilters" in plan


def test_month_read_is_pruned(spark):
    from chainfold.sources.files import read_month

    path = scratch_dir(spark, "t-plan-month")
    write_partitions(quarantine(event_transfers(spark, SMOKE_DIR)), path)
    plan = _plan(read_month(spark, path, 2024, 1, SILVER))
    assert "PartitionFilters: [isnotnull(year" in plan and "(month" in plan


def test_merge_computes_its_batch_once(spark, tmp_path):
    """The merge reads the batch into an intermediate table once; its result,
    and gold over it, read only the touched months of the Parquet table."""
    from pyspark.sql import functions as F

    from chainfold.sinks.files import merge_months

    ev = event_transfers(spark, SMOKE_DIR)
    path = scratch_dir(spark, "t-plan-merge")
    for k in (0, 1, 2):
        merge_months(quarantine(ev.withColumn("block_date", F.add_months("block_date", k))), path)
    csv = scratch_dir(spark, "t-plan-csv")
    ev.write.option("header", True).csv(csv)
    reads = spark.sparkContext.accumulator(0)

    def seen(x):
        reads.add(1)
        return x

    raw = spark.read.option("header", True).csv(csv)
    counted = raw.withColumn("tx_hash", F.udf(seen, "string")("tx_hash"))
    clean = quarantine(counted.withColumn("block_date", F.add_months(F.col("block_date").cast("date"), 2)))
    clean.write.format("noop").mode("overwrite").save()
    once = reads.value
    merged = merge_months(clean, path)
    assert once > 0 and reads.value == 2 * once
    plan = _plan(weekly_activity(merged, "vertical"))
    assert reads.value == 2 * once
    assert "csv" not in plan.lower().replace("t-plan-csv", "csv") and "PartitionFilters: [" in plan and "year" in plan


def test_size_check_sends_no_rows_to_one_task(spark):
    from chainfold.operators.joins import has_at_most

    lines = []
    real = type(spark.range(0)).first

    def first(self):
        lines.append(_plan(self))
        return real(self)

    type(spark.range(0)).first = first
    try:
        has_at_most(event_transfers(spark, SMOKE_DIR), 5)
    finally:
        type(spark.range(0)).first = real
    assert "GlobalLimit" not in lines[0] and "partial_count" in lines[0]


def test_logs_are_read_for_the_days_of_the_transfers(spark):
    inp = label_inputs(spark, SMOKE_DIR)
    path = scratch_dir(spark, "t-plan-logs")
    inp["logs"].where("block_date IS NOT NULL").write.partitionBy("block_date").parquet(path)
    day = {"first_day": "1998-04-01", "last_day": "1998-04-30"}
    pruned = L.label_transfers(inp | {"logs": spark.read.parquet(path)}, **day)
    plan = _plan(pruned)
    assert "PartitionFilters: [isnotnull(block_date" in plan and "block_date#" in plan
    first, last = pruned.selectExpr("min(block_date)", "max(block_date)").first()
    logs = [part for part in plan.split("\n\n") if path.rsplit("/", 1)[1] in part]
    assert logs and all(f">= {first}" in p and f"<= {last}" in p for p in logs)
    # the mapping repeats some log positions on other days, which a chain can't
    own_days = inp["logs"].where(f"block_date BETWEEN '{first}' AND '{last}'").drop("block_date")
    whole = materialize(L.label_transfers(inp | {"logs": own_days}, **day))
    pruned = materialize(pruned)
    assert pruned.count() > 0 and pruned.exceptAll(whole).isEmpty() and whole.exceptAll(pruned).isEmpty()
    every = materialize(L.label_transfers(inp | {"logs": spark.read.parquet(path)}, **day, log_slack_days=10_000))
    whole = materialize(L.label_transfers(inp | {"logs": inp["logs"].drop("block_date")}, **day))
    assert every.exceptAll(whole).isEmpty() and whole.exceptAll(every).isEmpty()
    wide = _plan(L.logs_of_days(spark.read.parquet(path), first, last, slack_days=2))
    assert f">= {first - dt.timedelta(days=2)}" in wide and f"<= {last + dt.timedelta(days=2)}" in wide


def test_bucketed_label_tables_are_not_shuffled(spark):
    """Every exchange of the plan moves receivers; no label table is below one."""
    from chainfold.operators.compare import same_rows
    from chainfold.sinks.files import write_label_tables

    inp = label_inputs(spark, SMOKE_DIR)
    roles = ("ens", "contracts", "addresses")
    tables = write_label_tables(spark, {r: inp[r] for r in roles}, scratch_dir(spark, "t-labels"), 8)
    recv = materialize(L.receivers(inp["transfers"]))
    got = L.bucketed_receiver_labels(recv, **tables)
    assert same_rows(got, L.receiver_labels(recv, *(inp[r] for r in roles))).isEmpty()
    tree = got._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in tree]
    scans = [i for i, line in enumerate(tree) if "FileScan parquet" in line and "label_" in line]
    assert len(scans) == 3 and all("Bucketed: true" in tree[i] for i in scans)
    for i in scans:
        at = depth[i]
        for j in range(i, -1, -1):
            if depth[j] < at:
                at = depth[j]
                if "SortMergeJoin" in tree[j]:
                    break
                assert "Exchange" not in tree[j], tree[j]
