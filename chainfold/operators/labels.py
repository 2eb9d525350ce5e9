"""Label step: from raw transfers and label tables to labelled transfers.

Plan, for ``transfers`` with one day (or many) of rows:

1. ``wallet_transfers``: date range, positive amount, sender is a wallet
   (semi join; the wallet list is broadcast only if it is proven small).
2. ``receivers``: distinct (blockchain, address) of the receivers. Every
   per-receiver fact is computed on this table, not per transfer, so a hot
   receiver (one address may get a third of all transfers) costs one row
   here; partial aggregation collapses it before the shuffle.
3. ``receiver_info``: the label tables are pre-aggregated by their key with
   MIN/MAX (so their rows never multiply each other), restricted to the
   receivers by a broadcast semi join when the receiver set is proven
   small, then left-joined to the receivers. Two aggregations cover all six
   tables: address labels and contract names per (blockchain, address);
   ENS names and the four address lists (wallet, burn address, created
   contract, staker) per address.
4. ``receiver_profiles``: type, displayed names, vertical (by the table of
   rules, see ``name_rules``) and protocol, still one row per receiver.
5. One join of the transfers to the per-receiver table, one to the
   stablecoin list (broadcast after a size check) and one to the event
   names, whose hot keys are dealt in blocks of both sides.

The wallet transfers and the receivers each feed several later steps and
size checks, so ``label_transfers`` materializes them once (Parquet below the
shared checkpoint folder) instead of re-running the plan above them for every
use.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainfold.operators import rules as R
from chainfold.operators.name_rules import classify_vertical, default_rules
from chainfold.operators.joins import (
    DEFAULT_BROADCAST_ROWS,
    broadcast_if_bounded,
    has_at_most,
    join_small_side,
    key_filter,
    materialize,
    split_hot_join,
    two_sided_join,
)
from chainfold.schemas import LABELLED


def wallet_transfers(
    transfers: DataFrame,
    wallets: DataFrame,
    first_day: str | None = None,
    last_day: str | None = None,
    *,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Transfers in ``[first_day, last_day]`` (open ends if None) with
    ``amount_usd > 0`` whose sender is in ``wallets.address``."""
    t = transfers
    if first_day is not None:
        t = t.where(F.col("block_date") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        t = t.where(F.col("block_date") <= F.lit(last_day).cast("date"))
    t = t.where(F.col("amount_usd") > 0)
    w = wallets.select(F.col("address").alias("from")).where(F.col("from").isNotNull())
    hinted, small = broadcast_if_bounded(w, max_broadcast_rows)
    if small:
        return t.join(hinted, "from", "left_semi")
    return split_hot_join(materialize(t), w.distinct(), ["from"], "left_semi")


def previous_day_transfers(transfers: DataFrame, run_date: str) -> DataFrame:
    """``block_date = run_date - 1 day`` (the daily slice)."""
    return transfers.where(F.col("block_date") == F.date_sub(F.lit(run_date).cast("date"), 1))


def receivers(transfers: DataFrame) -> DataFrame:
    """Distinct (blockchain, address) of non-NULL receivers."""
    return (
        transfers.select("blockchain", F.col("to").alias("address"))
        .where(F.col("address").isNotNull())
        .distinct()
    )


def _restrict(table: DataFrame, keys: DataFrame, on: list[str], small: bool) -> DataFrame:
    """Keep rows of a (large) label table whose key occurs in ``keys``.

    When ``keys`` is proven small (``small``), a broadcast semi join filters
    the label table where it is read; otherwise it is a shuffle semi join
    with the distinct keys. The rows kept are the same.
    """
    if small:
        # No distinct: duplicate keys do not change a semi join, and the size
        # check already bounds the broadcast by the rows of ``keys``.
        return table.join(F.broadcast(keys.select(*on)), on, "left_semi")
    return table.join(keys.select(*on).distinct(), on, "left_semi")


def _logs_at(logs: DataFrame, keys: DataFrame, on: list[str], small: bool) -> DataFrame:
    """The logs whose key occurs in ``keys``. Beyond the bound most others are dropped where
    they are read, by their transaction, so that few are shuffled."""
    if small:
        return _restrict(logs, keys, on, small)
    # An inner join with distinct keys: a semi join would be moved below the filter.
    return key_filter(logs, keys, "tx_hash").join(keys.select(*on).distinct(), on).select(*logs.columns)


def _is_small(df: DataFrame, small: bool | None, max_rows: int) -> bool:
    return has_at_most(df, max_rows) if small is None else small


def _chain_labels(
    recv: DataFrame, contracts: DataFrame, addresses: DataFrame, small: bool
) -> DataFrame:
    """Per (blockchain, address): MIN label name, category, model (usable
    labels only) and MIN contract name, from one aggregation over the union
    of both label tables (each leaves the other's columns NULL, which MIN
    ignores)."""
    ck = ["blockchain", "address"]
    null = F.lit(None).cast("string")
    label_rows = addresses.where(R.label_kept()).select(
        *ck,
        F.col("name").alias("label_names"),
        F.col("category").alias("label_categories"),
        F.col("model_name").alias("label_models"),
        null.alias("contract_name"),
    )
    contract_rows = contracts.select(
        *ck,
        null.alias("label_names"),
        null.alias("label_categories"),
        null.alias("label_models"),
        F.col("name").alias("contract_name"),
    )
    both = _restrict(label_rows.unionByName(contract_rows), recv, ck, small)
    return both.groupBy(*ck).agg(
        *[F.min(c).alias(c) for c in ("label_names", "label_categories", "label_models", "contract_name")]
    )


FLAGS = ("is_safe", "is_burn", "is_contract", "is_staker")


def _address_facts(
    recv: DataFrame,
    ens: DataFrame | None,
    lists: dict[str, DataFrame],
    small: bool,
) -> DataFrame:
    """Per address: MIN ENS name and one boolean per address list in
    ``lists`` (flag name to a frame with ``address``), from one aggregation
    over the union of all of them."""
    flags = list(lists)
    parts = []
    if ens is not None:
        parts.append(ens.select("address", F.col("name").alias("ens"), *[F.lit(False).alias(f) for f in flags]))
    for flag, src in lists.items():
        parts.append(
            src.select("address", F.lit(None).cast("string").alias("ens"), *[F.lit(f == flag).alias(f) for f in flags])
        )
    tagged = parts[0]
    for p in parts[1:]:
        tagged = tagged.unionByName(p)
    tagged = _restrict(tagged.where(F.col("address").isNotNull()), recv, ["address"], small)
    return tagged.groupBy("address").agg(F.min("ens").alias("ens"), *[F.max(f).alias(f) for f in flags])


def bucketed_receiver_labels(recv: DataFrame, ens: DataFrame, contracts: DataFrame, addresses: DataFrame) -> DataFrame:
    """``receiver_labels`` over label tables bucketed by their key (``sinks.files.write_label_tables``).

    Each table is reduced and joined where its buckets lie; only the receivers
    are shuffled, once by (blockchain, address) and once by address. Meant for
    receivers beyond the broadcast bound, where ``receiver_labels`` would
    shuffle the label tables.
    """
    ck = ["blockchain", "address"]
    labels = addresses.where(R.label_kept()).groupBy(*ck).agg(
        F.min("name").alias("label_names"), F.min("category").alias("label_categories"), F.min("model_name").alias("label_models")
    )
    names = contracts.groupBy(*ck).agg(F.min("name").alias("contract_name"))
    owners = ens.groupBy("address").agg(F.min("name").alias("ens"))
    # merge joins: a broadcast of a label table would be neither bounded nor needed
    on_chain = recv.select(*ck).join(labels.hint("merge"), ck, "left").join(names.hint("merge"), ck, "left")
    return on_chain.join(owners.hint("merge"), "address", "left").select(
        *ck, "label_names", "label_categories", "label_models", "contract_name", "ens"
    )


def receiver_labels(
    recv: DataFrame,
    ens: DataFrame,
    contracts: DataFrame,
    addresses: DataFrame,
    *,
    recv_is_small: bool | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """One row per receiver (blockchain, address): MIN of label name,
    category and model (usable labels only), MIN contract name of the same
    chain, MIN ENS name of the address.

    Each label table is reduced to one row per key with MIN before it is
    joined, which equals MIN over the joined rows but never multiplies the
    rows of one table by those of another."""
    small = _is_small(recv, recv_is_small, max_broadcast_rows)
    chain = _chain_labels(recv, contracts, addresses, small)
    addr = _address_facts(recv, ens, {}, small)
    return (
        recv.select("blockchain", "address")
        .join(chain, ["blockchain", "address"], "left")
        .join(addr, "address", "left")
        .select("blockchain", "address", "label_names", "label_categories", "label_models", "contract_name", "ens")
    )


def receiver_flags(
    recv: DataFrame,
    wallets: DataFrame,
    burn: DataFrame,
    creation: DataFrame,
    stakers: DataFrame,
    *,
    recv_is_small: bool | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """One row per receiver address: is_safe, is_burn, is_contract, is_staker.

    The four address lists are tagged and unioned, then reduced with MAX per
    address: one shuffle for all four membership tests."""
    small = _is_small(recv, recv_is_small, max_broadcast_rows)
    lists = dict(zip(FLAGS, (wallets, burn, creation, stakers), strict=True))
    per_address = _address_facts(recv, None, lists, small)
    return (
        recv.select("address")
        .distinct()
        .join(per_address, "address", "left")
        .select("address", *[F.coalesce(F.col(f), F.lit(False)).alias(f) for f in FLAGS])
    )


def receiver_info(
    recv: DataFrame,
    inputs: dict[str, DataFrame],
    *,
    recv_is_small: bool | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Labels, ENS name and the four flags per receiver (blockchain, address):
    two aggregations (chain level, address level) and two joins."""
    small = _is_small(recv, recv_is_small, max_broadcast_rows)
    chain = _chain_labels(recv, inputs["contracts"], inputs["addresses"], small)
    lists = dict(zip(FLAGS, (inputs["wallets"], inputs["burn"], inputs["creation"], inputs["stakers"]), strict=True))
    addr = _address_facts(recv, inputs["ens"], lists, small)
    return (
        recv.select("blockchain", "address")
        .join(chain, ["blockchain", "address"], "left")
        .join(addr, "address", "left")
    )


def receiver_types(
    transfers: DataFrame,
    inputs: dict[str, DataFrame],
    *,
    materialize_steps: bool = True,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """``transfers`` with ``receiver_type`` added (Safe, Burner address,
    Smart contract, EOA, tested in that order).

    The flags are computed once per distinct receiver address and joined
    back by broadcast when the receiver set is proven small, else by a
    shuffle join that splits hot receivers.
    """
    keep = materialize if materialize_steps else (lambda df: df)
    t = keep(transfers)
    recv = keep(receivers(t))
    small = has_at_most(recv, max_broadcast_rows)
    flags = receiver_flags(
        recv, inputs["wallets"], inputs["burn"], inputs["creation"], inputs["stakers"], recv_is_small=small
    ).withColumnRenamed("address", "to")
    if small:
        j = t.join(F.broadcast(flags), "to", "left")
    else:
        j = split_hot_join(t, flags, ["to"], "left")
    f = lambda c: F.coalesce(F.col(c), F.lit(False))
    return j.withColumn("receiver_type", R.receiver_type(f("is_safe"), f("is_burn"), f("is_contract"))).drop(*FLAGS)


def event_names(
    logs: DataFrame,
    transfers: DataFrame,
    *,
    tx_is_small: bool | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Distinct (tx_hash, index, event_name) of the transfers' transactions."""
    tx = transfers.select("tx_hash").where(F.col("tx_hash").isNotNull())
    small = _is_small(tx, tx_is_small, max_broadcast_rows)
    return _logs_at(logs, tx, ["tx_hash"], small).select("tx_hash", "index", "event_name").distinct()


def stablecoin_flag(
    transfers: DataFrame, stablecoins: DataFrame, *, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS
) -> DataFrame:
    """Add ``is_stablecoin``: (blockchain, contract_address) is on the list."""
    stb = (
        stablecoins.select("blockchain", F.col("stablecoin_address").alias("contract_address"))
        .where(F.col("contract_address").isNotNull())
        .distinct()
        .withColumn("is_stablecoin", F.lit(True))
    )
    # A token contract may carry a large share of all transfers, so the list
    # is broadcast when small and otherwise joined with hot keys split. The
    # raw list bounds its distinct rows, so it is what the check counts.
    out = join_small_side(
        transfers,
        stb,
        ["blockchain", "contract_address"],
        "left",
        max_rows=max_broadcast_rows,
        probe=stablecoins,
    )
    return out.withColumn("is_stablecoin", F.coalesce(F.col("is_stablecoin"), F.lit(False)))


def attach_receiver_info(
    transfers: DataFrame,
    info: DataFrame,
    *,
    same_chain: bool = True,
    info_is_small: bool | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Left-join per-receiver info to the transfers.

    ``same_chain=True`` matches (blockchain, receiver) with NULL-safe
    blockchain equality; ``False`` matches on the address only, so a
    receiver seen on several chains gets one row per chain (the original
    behaviour). Broadcast when the receiver table is proven small, else a
    shuffle join that splits hot receivers of the materialized transfers.
    """
    keys = ["to", "blockchain"] if same_chain else ["to"]
    i = info.withColumnRenamed("address", "to").where(F.col("to").isNotNull())
    if not same_chain:
        i = i.drop("blockchain")
    if not _is_small(i, info_is_small, max_broadcast_rows):
        return split_hot_join(materialize(transfers), i, keys, "left", null_safe=True)
    i = F.broadcast(i.withColumnsRenamed({k: f"label_{k}" for k in keys}))
    conds = [F.col(k).eqNullSafe(F.col(f"label_{k}")) for k in keys]
    return transfers.join(i, conds, "left").drop(*[f"label_{k}" for k in keys])


def receiver_profiles(
    info: DataFrame, name_rules: DataFrame, *, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS
) -> DataFrame:
    """``receiver_info`` with receiver type, displayed names, vertical and protocol."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    named = info.withColumns(
        {
            "receiver_type": R.receiver_type(flag("is_safe"), flag("is_burn"), flag("is_contract")),
            "receiver_contract_name": R.display_contract_name(F.col("contract_name")),
            "receiver_name": R.receiver_name(
                F.col("label_models"), F.col("label_names"), F.col("contract_name"), F.col("ens")
            ),
        }
    )
    classified = classify_vertical(named, None, name_rules, max_broadcast_rows=max_broadcast_rows)
    return classified.withColumn("protocol", R.protocol(F.col("receiver_contract_name"), F.col("receiver_type"))).drop(
        "contract_name", *FLAGS
    )


def logs_of_days(logs: DataFrame, first: object, last: object, *, slack_days: int = 0, day_col: str = "block_date") -> DataFrame:
    """Logs from ``slack_days`` before ``first`` to as many after ``last`` (dates).

    The bounds are literals, so a log table partitioned by ``day_col`` lists
    and reads those days only. Logs without that column are returned whole.
    """
    if day_col not in logs.columns or first is None:
        return logs
    day = F.col(day_col)
    return logs.where(
        (day >= F.lit(first - dt.timedelta(days=slack_days))) & (day <= F.lit(last + dt.timedelta(days=slack_days)))
    )


TRANSFER_COLUMNS = (
    "blockchain block_date block_time tx_hash evt_index from to contract_address token_standard symbol amount amount_usd".split()
)

# Labelled columns that take a transfer column of which no step makes use.
CARRIED = {
    "block_time": "block_time",
    "token_category": "token_standard",
    "safe_sender": "from",
    "symbol": "symbol",
    "amount": "amount",
    "amount_usd": "amount_usd",
}


def label_transfers(
    inputs: dict[str, DataFrame],
    first_day: str | None = None,
    last_day: str | None = None,
    *,
    same_chain: bool = True,
    order_by_date: bool = False,
    materialize_steps: bool = True,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    log_slack_days: int = 0,
    columns: Collection[str] | None = None,
) -> DataFrame:
    """The whole label step; returns the 21 labelled columns, or those named in ``columns``.

    ``inputs`` holds DataFrames under the keys transfers, wallets, ens,
    contracts, addresses, logs, burn, creation, stablecoins, stakers, and
    optionally name_rules (``name_rules.default_rules`` without it). The
    result keeps the input types (see ``to_labelled_schema``).

    Logs with a ``block_date`` are read for the days of the transfers only,
    and ``log_slack_days`` on either side.

    Transfer columns that no step and none of ``columns`` needs are neither
    shuffled nor written; the steps and their rows are the same.

    ``materialize_steps`` writes the wallet transfers and the receivers
    (see the module docstring); without it every size check re-runs the
    plan above it.
    """
    kw = {"max_broadcast_rows": max_broadcast_rows}
    keep = materialize if materialize_steps else (lambda df: df)
    wanted = (lambda name: True) if columns is None else (lambda name: name in columns)
    idle = {source for name, source in CARRIED.items() if not wanted(name)}
    transfers = inputs["transfers"].select(*[c for c in TRANSFER_COLUMNS if c not in idle - {"from", "amount_usd"}])
    t = keep(wallet_transfers(transfers, inputs["wallets"], first_day, last_day, **kw).drop(*idle))
    recv = keep(receivers(t))
    # The transfers bound both their transaction ids and their receivers, so
    # one check usually answers both; the receivers are counted on their own
    # only when the transfers exceed the bound.
    t_small = has_at_most(t, max_broadcast_rows)
    small = t_small or has_at_most(recv, max_broadcast_rows)
    rules = inputs["name_rules"] if "name_rules" in inputs else default_rules(recv.sparkSession)
    profiles = receiver_profiles(receiver_info(recv, inputs, recv_is_small=small, **kw), rules, **kw)
    days = t.agg(F.min("block_date").cast("date"), F.max("block_date").cast("date")).first()
    logs = logs_of_days(inputs["logs"], days[0], days[1], slack_days=log_slack_days)
    keys = t.select("tx_hash", F.col("evt_index").alias("index")).dropna()
    evt = _logs_at(logs, keys, ["tx_hash", "index"], t_small).select("tx_hash", F.col("index").alias("evt_index"), "event_name").distinct()
    # Both the transfers and the event names may repeat a key. Below the bound a plain join holds few rows.
    j = t.join(evt, ["tx_hash", "evt_index"], "left") if t_small else two_sided_join(t, keep(evt), ["tx_hash", "evt_index"], "left")
    # Where a list or the profiles exceed the bound, these materialize the rows that they split.
    j = stablecoin_flag(j, inputs["stablecoins"], **kw)
    j = attach_receiver_info(j, profiles, same_chain=same_chain, info_is_small=small, **kw)
    # a transfer without a receiver has no profile
    rtype = F.coalesce("receiver_type", F.lit(R.EOA))
    j = j.withColumns(
        {
            "receiver_type": rtype,
            "vertical": F.coalesce("vertical", R.unclassified(rtype)),
            "protocol": F.coalesce("protocol", R.unclassified(rtype)),
        }
    )
    if order_by_date:
        j = j.orderBy("block_date")
    out = {
        "blockchain": F.col("blockchain"),
        "block_date": F.col("block_date"),
        "block_time": F.col("block_time"),
        "tx_hash": F.col("tx_hash"),
        "token_category": R.token_category(F.col("is_stablecoin"), F.col("token_standard")),
        "safe_sender": F.col("from"),
        "receiver": F.col("to"),
        "receiver_type": F.col("receiver_type"),
        "receiver_contract_name": F.col("receiver_contract_name"),
        "receiver_label_names": F.col("label_names"),
        "receiver_label_categories": F.col("label_categories"),
        "receiver_label_models": F.col("label_models"),
        "receiver_ens": F.col("ens"),
        "receiver_name": F.col("receiver_name"),
        "event_name": F.col("event_name"),
        "symbol": F.col("symbol"),
        "token_address": F.col("contract_address"),
        "amount": F.col("amount"),
        "amount_usd": F.col("amount_usd"),
        "vertical": F.col("vertical"),
        "protocol": F.col("protocol"),
    }
    return j.select(*[column.alias(name) for name, column in out.items() if wanted(name)])


TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS 'UTC'"


def to_labelled_schema(df: DataFrame) -> DataFrame:
    """Cast to the fixed 21-column schema (strings and doubles), by name;
    absent columns become NULL. A timestamp ``block_time`` is written as
    ``yyyy-MM-dd HH:mm:ss.SSS UTC``."""
    types = dict(df.dtypes)
    cols = []
    for f in LABELLED.fields:
        if f.name not in types:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f.name)
        if f.name == "block_time" and types[f.name].startswith("timestamp"):
            c = F.date_format(c, TIME_FORMAT)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
