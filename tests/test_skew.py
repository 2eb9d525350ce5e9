"""Hot keys: one vertical and one receiver hold most of the rows.

The shuffle paths (forced with a zero broadcast bound) must give exactly the
rows of the broadcast paths; these are the plans a cluster uses when a side
is too large to broadcast.
"""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from chainfold.operators import gold as G
from chainfold.operators import joins as J
from chainfold.operators import labels as L
from chainfold.operators.compare import same_rows
from chainfold.operators.joins import has_at_most, hot_keys, materialize, split_hot_join, two_sided_join
from chainfold.plans.testdata import label_inputs
from tests.conftest import SMOKE_DIR


def _skewed_silver(spark, n=60_000):
    # Half the rows in one vertical and one week; the rest spread out.
    ids = spark.range(n)
    hot = F.col("id") % 2 == 0
    return ids.select(
        (F.col("id") % 5000).cast("string").alias("tx_hash"),
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("v"), (F.col("id") % 7).cast("string"))).alias("vertical"),
        F.when(hot, F.lit("p")).otherwise(F.concat(F.lit("p"), (F.col("id") % 3).cast("string"))).alias("protocol"),
        ((F.col("id") % 1000) / 4 + 0.25).alias("amount_usd"),
        F.when(hot, F.lit(2)).otherwise((F.col("id") % 4 + 1).cast("int")).alias("week_of_month"),
        F.lit(3).cast("int").alias("week_of_year"),
        F.lit(2024).cast("int").alias("year"),
        F.lit(1).cast("int").alias("month"),
    )


def test_gold_hot_vertical(spark):
    s = _skewed_silver(spark)
    fast = G.weekly_activity(s, "vertical")
    split = G.weekly_activity(s, "vertical", max_broadcast_groups=0)
    assert same_rows(fast, split).count() == 0
    hot = fast.where("vertical = 'hot'").agg(F.sum("total_transactions_per_safe")).first()[0]
    assert hot == 30_000


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_split_join_equals_a_plain_join(spark, how, null_safe):
    big = spark.range(40_000).select(
        F.when(F.col("id") % 3 != 0, F.lit(0)).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 5000).alias("k"),
        F.col("id").alias("row"),
    )
    small = spark.range(2000).select(F.when(F.col("id") == 5, None).otherwise(F.col("id")).alias("k"), (F.col("id") * 10).alias("v"))
    got = split_hot_join(big, small, ["k"], how, null_safe=null_safe)
    other = small.withColumnRenamed("k", "j")
    cond = F.col("k").eqNullSafe(F.col("j")) if null_safe else F.col("k") == F.col("j")
    plain = big.join(other, cond, how).drop("j")
    assert same_rows(got.select(*plain.columns), plain).count() == 0


def test_hot_key_rows_stay_where_they_are(spark):
    """The rows of a hot key meet their partner by broadcast; only the others are shuffled, and nothing is copied."""
    big = spark.range(60_000, numPartitions=6).select(F.when(F.col("id") % 3 != 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("row"))
    small = spark.range(-10, 60_000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    got = split_hot_join(big, small, ["k"], "left")
    hot = got.where("k = -1").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(hot) == 6 and sum(r["count"] for r in hot) == 40_000


BOUNDED = {
    "wallet_transfers": lambda i, t, **kw: L.wallet_transfers(i["transfers"], i["wallets"], **kw),
    "receiver_labels": lambda i, t, **kw: L.receiver_labels(L.receivers(t), i["ens"], i["contracts"], i["addresses"], **kw),
    "receiver_flags": lambda i, t, **kw: L.receiver_flags(L.receivers(t), i["wallets"], i["burn"], i["creation"], i["stakers"], **kw),
    "receiver_types": lambda i, t, **kw: L.receiver_types(t, i, **kw),
    "event_names": lambda i, t, **kw: L.event_names(i["logs"], t, **kw),
    "stablecoin_flag": lambda i, t, **kw: L.stablecoin_flag(t, i["stablecoins"], **kw),
    "attach_same_chain": lambda i, t, **kw: L.attach_receiver_info(t, L.receiver_info(L.receivers(t), i), **kw),
    "attach_any_chain": lambda i, t, **kw: L.attach_receiver_info(t, L.receiver_info(L.receivers(t), i), same_chain=False, **kw),
    "label_transfers": lambda i, t, **kw: L.label_transfers(i, **kw),
}


@pytest.fixture(scope="module")
def label_case(spark):
    inputs = label_inputs(spark, SMOKE_DIR)
    odd = inputs["transfers"].limit(40).withColumn("to", F.lit(None).cast(inputs["transfers"].schema["to"].dataType))
    inputs["transfers"] = materialize(inputs["transfers"].unionByName(odd))
    return inputs, materialize(L.wallet_transfers(inputs["transfers"], inputs["wallets"]))


@pytest.mark.parametrize("name", sorted(BOUNDED))
def test_no_bound_changes_a_result(label_case, name):
    inputs, transfers = label_case
    plain, beyond = (BOUNDED[name](inputs, transfers, **kw) for kw in ({}, {"max_broadcast_rows": 0}))
    assert plain.count() > 0
    assert same_rows(plain, beyond.select(*plain.columns)).count() == 0


def test_byte_bound(spark):
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("s"), F.col("id"))
    assert has_at_most(wide, 10) and not has_at_most(wide, 9)
    assert has_at_most(wide, 10, max_bytes=10_080) and not has_at_most(wide, 10, max_bytes=10_079)


def test_label_step_hot_receiver(spark):
    n = 20_000
    t = spark.range(n).select(
        F.lit("ethereum").alias("blockchain"),
        F.lit("2024-11-23").cast("date").alias("block_date"),
        F.lit("2024-11-23 00:00:00").alias("block_time"),
        F.col("id").cast("string").alias("tx_hash"),
        F.lit(0).alias("evt_index"),
        F.lit("w").alias("from"),
        # Two of every three transfers go to one receiver.
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise((F.col("id") % 100).cast("string")).alias("to"),
        F.lit("tok").alias("contract_address"),
        F.lit("erc20").alias("token_standard"),
        F.lit("S").alias("symbol"),
        F.lit(1.0).alias("amount"),
        F.lit(5.0).alias("amount_usd"),
    )

    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    inputs = {
        "transfers": t,
        "wallets": df([("w",)], "address string"),
        "ens": df([("hot", "hot.eth")], "address string, name string"),
        "contracts": df([("hot", "ethereum", "Aave_v3: Pool"), ("7", "ethereum", "Lido: stETH")], "address string, blockchain string, name string"),
        "addresses": df([], "address string, blockchain string, name string, category string, model_name string, label_type string"),
        "logs": df([("1", 0, "Transfer")], "tx_hash string, index int, event_name string"),
        "burn": df([("9",)], "address string"),
        "creation": df([("hot",)], "address string"),
        "stablecoins": df([("ethereum", "tok")], "blockchain string, stablecoin_address string"),
        "stakers": df([], "address string"),
    }
    fast = L.label_transfers(inputs)
    split = L.label_transfers(inputs, max_broadcast_rows=0, materialize_steps=False)
    assert fast.count() == n
    assert same_rows(fast, split).count() == 0
    counts = {r.vertical: r[1] for r in fast.groupBy("vertical").count().collect()}
    assert counts["lending"] == n - (n + 2) // 3
    assert counts["liquid staking"] == len(range(7, n, 100)) - len([i for i in range(7, n, 100) if i % 3 != 0])


@pytest.mark.parametrize("how", ["inner", "left"])
def test_two_sided_join_equals_a_plain_join(spark, how):
    """Keys hot on both sides, on one side only, without a partner, and NULL."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 3 == 1, F.lit(-1)).when(F.col("id") % 50 == 2, F.lit(None))
    left = spark.range(1200).select(key.otherwise(F.col("id") % 90).alias("k"), F.lit("x").alias("c"), (F.col("id") % 4).alias("l"))
    other = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 50 == 1, F.lit(None)).when(F.col("id") % 7 == 1, F.lit(5))
    right = spark.range(900).select(other.otherwise(F.col("id") % 200 + 5).alias("k"), (F.col("id") % 5).alias("r"))
    got = two_sided_join(materialize(left), materialize(right), ["k"], how, parts=20)
    assert same_rows(got, left.join(right, "k", how)).count() == 0


def test_one_transaction_with_a_third_of_all_logs_and_transfers(spark):
    n = 6000
    hot = F.col("id") % 3 == 0
    t = spark.range(n).select(F.when(hot, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("tx_hash"), F.lit(0).alias("evt_index"), F.col("id").alias("row"))
    logs = spark.range(600).select(
        F.when(hot, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("tx_hash"), F.lit(0).alias("evt_index"), F.col("id").cast("string").alias("event_name")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        got = two_sided_join(materialize(t), materialize(logs), ["tx_hash", "evt_index"], "left", parts=20)
        tasks = [r["count"] for r in got.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    pairs = 2000 * 200
    assert sum(tasks) == pairs + 4000
    assert max(tasks) < 0.15 * pairs


def test_hot_event_keys_in_the_label_step(label_case):
    """Beyond the bound, transfers that share a log position with many event names."""
    inputs, _ = label_case
    t = inputs["transfers"]
    first = t.join(inputs["wallets"].withColumnRenamed("address", "from"), "from", "left_semi").select("tx_hash", "evt_index", "block_date").first()
    same = [F.when(F.col("amount") % 2 == 0, F.lit(first[c])).otherwise(F.col(c)).alias(c) for c in ("tx_hash", "evt_index", "block_date")]
    hot = t.select(*same, *[c for c in t.columns if c not in ("tx_hash", "evt_index", "block_date")])
    logs = inputs["logs"]
    more = logs.limit(50).select(
        F.lit(first["tx_hash"]).alias("tx_hash"),
        F.lit(first["evt_index"]).alias("index"),
        F.monotonically_increasing_id().cast("string").alias("event_name"),
        F.lit(first["block_date"]).alias("block_date"),
    )
    case = inputs | {"transfers": materialize(hot), "logs": materialize(logs.unionByName(more))}
    plain, beyond = L.label_transfers(case), L.label_transfers(case, max_broadcast_rows=0)
    assert plain.count() > 20 * 1000
    assert same_rows(plain, beyond.select(*plain.columns)).count() == 0


def _written(monkeypatch) -> list[tuple[str, tuple[str, ...]]]:
    """Name and columns of each intermediate table that the joins write from now on."""
    found, write = [], J.write_intermediate
    monkeypatch.setattr(J, "write_intermediate", lambda df, name: found.append((name, tuple(df.columns))) or write(df, name))
    return found


def test_label_step_beyond_the_bound_writes_transfers_once(spark, label_case, monkeypatch):
    """More transfers than the bound, but short lists and few receivers: those meet the transfers in passing."""
    inputs, transfers = label_case
    bound = transfers.count() - 1
    assert inputs["stablecoins"].count() <= bound and inputs["wallets"].count() <= bound
    written = _written(monkeypatch)
    got = L.label_transfers(inputs, max_broadcast_rows=bound)
    assert len([columns for _, columns in written if "amount_usd" in columns]) == 1
    monkeypatch.undo()
    assert same_rows(got, L.label_transfers(inputs)).count() == 0


def test_search_for_hot_keys_counts_the_keys_of_full_buckets_only(spark, monkeypatch):
    cold = spark.range(50_000).select((F.col("id") % 25_000).alias("k"))
    written = _written(monkeypatch)
    assert hot_keys(cold, ["k"], 20) is None and not written
    assert split_hot_join(cold, cold.distinct(), ["k"], "inner", parts=20).count() == 50_000 and not written
    assert two_sided_join(cold, cold, ["k"], parts=20).count() == 100_000 and not written
    none = F.lit(None).cast("long")
    mixed = cold.unionByName(spark.range(5000).select(F.when(F.col("id") % 2 == 0, none).otherwise(F.lit(7)).alias("k")))
    assert hot_keys(mixed, ["k"], 21) is None
    assert {r["k"] for r in hot_keys(mixed, ["k"], 22).collect()} == {7, None}
    assert hot_keys(mixed.where("k = 7").limit(20), ["k"], 20) is None
    assert hot_keys(mixed.where("k = 7").limit(21), ["k"], 20).collect() == [(7,)]


def test_two_sided_join_with_keys_of_different_types(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("int").alias("k"), F.col("id").alias("l"))
    right = spark.range(300).select(F.when(F.col("id") % 3 == 0, 4).otherwise(F.col("id")).alias("k"), F.col("id").alias("r"))
    got = two_sided_join(materialize(left), materialize(right), ["k"], "left", parts=20)
    assert same_rows(got, left.join(right, "k", "left").select(*got.columns)).count() == 0


def test_key_filter_keeps_every_row_with_a_key_and_few_others(spark):
    null = F.lit(None).cast("long")
    logs = spark.range(-200, 40_000).select(F.when(F.col("id") % 9 == 0, null).otherwise(F.col("id")).alias("k"), F.col("id").alias("row"))
    keys = spark.range(-200, 4000, 4).select(F.when(F.col("id") % 5 == 0, null).otherwise(F.col("id")).alias("k"))
    keys = materialize(keys.unionByName(keys))
    got = J.key_filter(logs, keys, "k")
    assert got.columns == logs.columns
    exact = logs.join(keys.distinct(), "k", "left_semi")
    assert same_rows(got.join(keys.distinct(), "k", "left_semi"), exact).count() == 0
    assert exact.count() <= got.count() < exact.count() + 400
    assert J.key_filter(logs, keys.where("k < 0 and k > 0"), "k").count() == 0
    # the hash of an int is not that of a long
    assert J.key_filter(logs, keys.select(F.col("k").cast("int").alias("k")), "k").count() == logs.count()


def test_logs_without_a_transfer_are_dropped_before_their_shuffle(label_case, monkeypatch):
    """Beyond the bound, the logs that reach the exact join are about those it keeps."""
    inputs, transfers = label_case
    reached, plain = [], L.key_filter
    monkeypatch.setattr(L, "key_filter", lambda *a: reached.append(plain(*a)) or reached[-1])
    got = L.event_names(inputs["logs"], transfers.limit(20), max_broadcast_rows=0)
    assert same_rows(got, L.event_names(inputs["logs"], transfers.limit(20))).count() == 0
    assert reached[0].count() < 0.5 * inputs["logs"].count()


def test_label_step_writes_no_transfer_column_that_nothing_needs(label_case, monkeypatch):
    inputs, transfers = label_case
    whole = L.label_transfers(inputs)
    for bound in (transfers.count() - 1, 0):
        with monkeypatch.context() as patch:
            written = _written(patch)
            some = L.label_transfers(inputs, max_broadcast_rows=bound, columns=["receiver", "vertical", "amount_usd"])
            of_transfers = [set(columns) for _, columns in written if {"evt_index", "to"} <= set(columns)]
        assert of_transfers and not any(columns & {"block_time", "symbol", "amount", "token_standard"} for columns in of_transfers)
        assert some.columns == ["receiver", "amount_usd", "vertical"]
        assert same_rows(some, whole.select(*some.columns)).count() == 0
    dated = L.label_transfers(inputs, order_by_date=True, columns=["receiver_name", "blockchain"])
    assert same_rows(dated, whole.select("blockchain", "receiver_name")).count() == 0
