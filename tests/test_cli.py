"""The command line runs each layer for a block date."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainfold.__main__ import main
from chainfold.operators.silver import quarantine
from chainfold.plans import medallion as M
from chainfold.plans.testdata import event_transfers
from chainfold.operators.compare import same_rows
from chainfold.schemas import LABELLED, conform
from chainfold.session import scratch_dir
from chainfold.sinks.files import write_result_pages
from chainfold.sources.files import read_table
from tests.conftest import SMOKE_DIR

DAY = "2024-01-14"


def test_daily_from_staging_then_pages(spark, capsys):
    ev = event_transfers(spark, SMOKE_DIR)
    day_rows = ev.where(F.col("block_date") == F.lit(DAY).cast("date"))
    staging = scratch_dir(spark, "t-stg")
    conform(day_rows, LABELLED).write.option("header", True).csv(staging)
    root = scratch_dir(spark, "t-cli")
    missing_pages = scratch_dir(spark, "t-nopages")
    assert main(["daily", "--root", root, "--date", DAY, "--pages", missing_pages, "--staging", staging]) == 0
    out = capsys.readouterr().out
    assert "top 5 vertical by total_amount_usd_per_safe" in out
    silver = read_table(spark, M.silver_path(root))
    expected = quarantine(day_rows)
    assert same_rows(silver.select(*expected.columns), expected).count() == 0
    gold = M.read_gold(spark, root, "vertical")
    assert gold.agg(F.sum("total_transactions_per_safe")).first()[0] == expected.count()

    # The same day again, now from result pages: nothing changes.
    pages = scratch_dir(spark, "t-pages")
    write_result_pages(conform(day_rows, LABELLED), pages, rows_per_page=50)
    for step in ("bronze", "silver", "gold"):
        assert main([step, "--root", root, "--date", DAY, "--pages", pages]) == 0
    again = read_table(spark, M.silver_path(root))
    assert same_rows(again.select(*expected.columns), expected).count() == 0
    assert main(["topk", "--root", root, "--date", DAY, "--k", "3"]) == 0
    assert "top 3 protocol by total_transactions_per_safe" in capsys.readouterr().out


def test_a_day_without_rows_ends_with_status_1(spark, capsys):
    root, staging = scratch_dir(spark, "t-cli-none"), scratch_dir(spark, "t-stg-none")
    conform(event_transfers(spark, SMOKE_DIR).limit(0), LABELLED).write.option("header", True).csv(staging)
    assert main(["daily", "--root", root, "--date", DAY, "--staging", staging]) == 1
    assert "nothing was written" in capsys.readouterr().err
