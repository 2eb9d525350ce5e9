"""Silver cleaning, gold aggregation and top-k on hand-made rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from chainfold.operators import gold as G
from chainfold.operators.compare import assert_same_rows, same_rows
from chainfold.operators.silver import quarantine
from chainfold.operators.topk import top_k
from chainfold.schemas import gold_schema
from tests.conftest import rows

RAW_COLS = "tx_hash string, event_name string, vertical string, protocol string, amount_usd string, token_category string, block_date string"
EOA = "unclassified transfer to EOA"
SC = "unclassified transfer to Smart contract"


def _raw(spark, data):
    return spark.createDataFrame(data, RAW_COLS)


def test_quarantine_filters_and_dedupes(spark):
    d = "2024-11-23"
    data = [
        ("a", "Transfer", EOA, EOA, "100.00", "stablecoin", d),
        ("a", "Transfer", EOA, EOA, "100.00", "stablecoin", d),  # exact duplicate
        ("b", "Transfer", EOA, EOA, "0.75", "erc20", d),  # sub-dollar string amount is positive
        ("c", "Approval", EOA, EOA, "5", "erc20", d),  # other event
        ("d", None, EOA, EOA, "5", "erc20", d),  # no event
        ("e", "Transfer", EOA, EOA, "0", "erc20", d),  # not positive
        ("f", "Transfer", EOA, EOA, "-3", "erc20", d),  # negative
        ("g", "Transfer", EOA, EOA, None, "erc20", d),  # no amount
        ("h", "Transfer", EOA, EOA, "junk", "erc20", d),  # not a number
        (None, "Transfer", EOA, EOA, "5", "erc20", d),  # no tx
        ("i", "Transfer", None, EOA, "5", "erc20", d),  # no vertical
        ("j", "Transfer", EOA, None, "5", "erc20", d),  # no protocol
    ]
    out = quarantine(_raw(spark, data))
    got = rows(out.select("tx_hash", "amount_usd", "week_of_month", "week_of_year", "year", "month"))
    assert got == [("a", 100.0, 4, 47, 2024, 11), ("b", 0.75, 4, 47, 2024, 11)]
    assert out.columns == [
        "token_category",
        "event_name",
        "tx_hash",
        "vertical",
        "protocol",
        "amount_usd",
        "block_date",
        "week_of_year",
        "week_of_month",
        "year",
        "month",
    ]


def test_quarantine_stamps_given_day_and_keeps_days_apart(spark):
    data = [
        ("a", "Transfer", EOA, EOA, "1", "erc20", "2024-01-13"),
        ("a", "Transfer", EOA, EOA, "1", "erc20", "2024-01-14"),
    ]
    # Each row's own day: two different transfers.
    assert quarantine(_raw(spark, data)).count() == 2
    # One given day: the rows become duplicates of each other.
    one = quarantine(_raw(spark, data), block_date="2024-01-14")
    assert rows(one.select("block_date", "week_of_month")) == [(dt.date(2024, 1, 14), 3)]
    monday = quarantine(_raw(spark, data), block_date="2024-01-14", week_start="monday")
    assert rows(monday.select("week_of_month")) == [(2,)]


def _silver(spark, data):
    df = spark.createDataFrame(
        data, "tx_hash string, vertical string, protocol string, amount_usd double, block_date string"
    )
    return quarantine(
        df.withColumn("event_name", F.lit("Transfer")).withColumn("token_category", F.lit("erc20"))
    )


# Three weeks of two months; two accounts come back within a week, one in another week.
ACTIVITY = [
    ("alpha", "DEX", "Curvefi", 12.345, "2023-03-06"),
    ("alpha", "DEX", "Curvefi", 7.655, "2023-03-08"),
    ("beta", "DEX", "Sushi", 1000.0, "2023-03-09"),
    ("beta", "lending", "Aave", 0.4, "2023-03-10"),
    ("gamma", "lending", "Aave", 55.5, "2023-03-14"),
    ("gamma", "lending", "Aave", 44.5, "2023-03-15"),
    ("alpha", "DEX", "Sushi", 3.0, "2023-03-15"),
    ("delta", "DEX", "Curvefi", 8.0, "2023-04-01"),
]


def test_gold_rows_of_several_weeks(spark):
    gold = G.weekly_activity(_silver(spark, ACTIVITY), "vertical")
    got = sorted(
        (r.month, r.week_of_year, r.week_of_month, r.vertical, r.safe_account, r.unique_safes, r.total_transactions_per_safe, r.total_amount_usd_per_safe)
        for r in gold.collect()
    )
    # Money is rounded per row: 12.345 -> 12.35 and 7.655 -> 7.66.
    assert got == [
        (3, 10, 2, "DEX", "alpha", 2, 2, Decimal("20.01")),
        (3, 10, 2, "DEX", "beta", 2, 1, Decimal("1000.00")),
        (3, 10, 2, "lending", "beta", 1, 1, Decimal("0.40")),
        (3, 11, 3, "DEX", "alpha", 1, 1, Decimal("3.00")),
        (3, 11, 3, "lending", "gamma", 1, 2, Decimal("100.00")),
        (4, 13, 1, "DEX", "delta", 1, 1, Decimal("8.00")),
    ]
    assert gold.columns == [f.name for f in gold_schema("vertical").fields]
    by_protocol = {(r.week_of_year, r.protocol): r.unique_safes for r in G.weekly_activity(_silver(spark, ACTIVITY), "protocol").collect()}
    assert by_protocol == {(10, "Curvefi"): 1, (10, "Sushi"): 1, (10, "Aave"): 1, (11, "Aave"): 1, (11, "Sushi"): 1, (13, "Curvefi"): 1}


def test_top_k_cuts_and_breaks_ties_by_name(spark):
    rows_ = [(f"t{i}", name, name, amount, "2023-03-06") for i, (name, amount) in enumerate([("g", 1), ("f", 2), ("e", 5), ("d", 5), ("c", 9), ("b", 3), ("a", 3)])]
    gold = G.weekly_activity(_silver(spark, [(a, b, c, float(d), e) for a, b, c, d, e in rows_]), "vertical")
    assert [r[0] for r in top_k(gold, "vertical", "total_amount_usd_per_safe", 5).collect()] == ["c", "d", "e", "a", "b"]


def test_a_kept_row_without_a_date_fails(spark):
    raw = _raw(spark, [("a", "Transfer", EOA, EOA, "1", "erc20", None)])
    with pytest.raises(Exception, match="block_date is not a date"):
        quarantine(raw).collect()
    dropped = _raw(spark, [("a", "Approval", EOA, EOA, "1", "erc20", None)])
    assert quarantine(dropped).collect() == []


def test_gold_null_keys(spark):
    # A NULL account gives a row with count 0; a NULL group key drops the group.
    s = spark.createDataFrame(
        [
            (None, "v", 1.0, 1, 1, 2024, 1),
            ("a", "v", 2.0, 1, 1, 2024, 1),
            ("b", None, 3.0, 1, 1, 2024, 1),
        ],
        "tx_hash string, vertical string, amount_usd double, week_of_month int, week_of_year int, year int, month int",
    )
    got = rows(G.weekly_activity(s, "vertical").select("safe_account", "unique_safes", "total_transactions_per_safe"))
    assert got == [("a", 1, 1), (None, 1, 0)] or got == [(None, 1, 0), ("a", 1, 1)]


def test_gold_shuffle_path_equals_broadcast(spark):
    from tests.conftest import CHECK_DIR
    from chainfold.plans.testdata import event_transfers

    silver = quarantine(event_transfers(spark, CHECK_DIR))
    fast = G.weekly_activity(silver, "protocol")
    split = G.weekly_activity(silver, "protocol", max_broadcast_groups=0)
    assert same_rows(fast, split).count() == 0
    # Every silver row is counted once in gold (no NULL keys here).
    assert fast.agg(F.sum("total_transactions_per_safe")).first()[0] == silver.count()


def test_gold_money_overflow_is_null(spark):
    s = spark.createDataFrame(
        [("a", "v", 9e13, 1, 1, 2024, 1), ("a", "v", 9e13, 1, 1, 2024, 1)],
        "tx_hash string, vertical string, amount_usd double, week_of_month int, week_of_year int, year int, month int",
    )
    r = G.weekly_activity(s, "vertical").first()
    assert r.total_transactions_per_safe == 2 and r.total_amount_usd_per_safe is None


def test_top_k_ties_and_filters(spark):
    g = spark.createDataFrame(
        [
            ("b", 5, Decimal("1.00"), 2024, 1),
            ("a", 5, Decimal("1.00"), 2024, 1),
            ("c", 3, Decimal("9.00"), 2024, 1),
            ("c", 9, Decimal("9.00"), 2024, 2),
        ],
        "vertical string, total_transactions_per_safe long, total_amount_usd_per_safe decimal(15,2), year int, month int",
    )
    assert rows(top_k(g, "vertical", "total_transactions_per_safe", 2), order=None) == [("a", 5), ("c", 12)]
    jan = top_k(g, "vertical", "total_transactions_per_safe", 2, year=2024, month=1).collect()
    assert [tuple(r) for r in jan] == [("a", 5), ("b", 5)]  # tie broken by name
    vol = top_k(g, "vertical", "total_amount_usd_per_safe", 1).collect()
    assert [tuple(r) for r in vol] == [("c", Decimal("18.00"))]
    assert top_k(g, "vertical", "total_amount_usd_per_safe", 1).columns == ["vertical", "highest_transaction_volume"]


def test_same_rows_both_directions(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (3,)], "x int")
    assert rows(same_rows(a, b)) == [("actual_only", 1), ("actual_only", 2), ("expected_only", 3)]
    assert_same_rows(a, a.select("x"))
    try:
        assert_same_rows(a, b)
    except AssertionError as e:
        assert "differ" in str(e)
    else:  # pragma: no cover
        raise AssertionError("expected a difference")
