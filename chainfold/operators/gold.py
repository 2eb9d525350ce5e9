"""Gold layer: per week and dimension, distinct accounts, counts and USD volume.

Physical plan (two scans of the silver slice, each with pruned columns):

1. ``per_entity``: group by (year, month, week keys, dimension, account);
   partial aggregation on the map side collapses a hot account before the
   only large shuffle.
2. ``totals``: distinct accounts per group, from a pruned scan (no
   amount) with partial aggregation at both levels; computed first as its
   own job and materialized (it has one row per group, so it is small).
3. ``per_entity`` joined to ``totals`` on the group keys. ``totals`` is
   broadcast once the run-time check on its materialized rows has shown
   the number of groups to be bounded; otherwise the join splits hot groups
   (one vertical may hold a third of all rows) over all tasks.

A window ``count(...) over (partition by group)`` would save a join but put
a whole group into one task, so it is not used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainfold.operators.joins import (
    DEFAULT_BROADCAST_ROWS,
    broadcast_if_bounded,
    materialize,
    split_hot_join,
)
from chainfold.schemas import MONEY, PARTITION_KEYS, WEEK_KEYS


def per_entity_totals(
    silver: DataFrame,
    dimension: str,
    entity_col: str = "tx_hash",
    amount_col: str = "amount_usd",
    group_cols: Sequence[str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """Per (group, account): ``count(account)`` and summed money.

    Money is cast to decimal(15,2) per row, then summed, then cast again
    (NULL on overflow), as the gold table stores it.
    """
    keys = list(group_cols) if group_cols is not None else _group_keys(silver, dimension)
    base = silver.select(
        *keys,
        F.col(entity_col).alias("safe_account"),
        F.col(amount_col).try_cast(MONEY).alias("amount_usd"),
    )
    per_entity = base.groupBy(*keys, "safe_account").agg(
        F.count("safe_account").alias("total_transactions_per_safe"),
        F.sum("amount_usd").try_cast(MONEY).alias("total_amount_usd_per_safe"),
    )
    return per_entity, keys


def weekly_activity(
    silver: DataFrame,
    dimension: str,
    entity_col: str = "tx_hash",
    amount_col: str = "amount_usd",
    *,
    max_broadcast_groups: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """One gold table (``dimension`` is ``"vertical"`` or ``"protocol"``).

    Output: week_of_month, week_of_year, <dimension>, unique_safes,
    safe_account, total_transactions_per_safe, total_amount_usd_per_safe,
    year, month. ``year``/``month`` are group keys when the input has them,
    so many months are aggregated in one job exactly as one month at a time
    would be.

    ``entity_col`` defaults to ``tx_hash``: the accounts counted are
    transactions, since silver keeps no sender column. Groups with a NULL
    key are dropped by the inner join; a NULL account yields a row with
    count 0.
    """
    per_entity, keys = per_entity_totals(silver, dimension, entity_col, amount_col)
    # Totals first, as their own small job: distinct accounts per group, read
    # from a pruned scan (no amount column). Materialized, so the size check
    # and the join read a handful of rows instead of recomputing them.
    accounts = silver.select(*keys, F.col(entity_col).alias("safe_account"))
    totals = materialize(accounts.distinct().groupBy(*keys).agg(F.count("safe_account").alias("unique_safes")))
    return _with_totals(per_entity, totals, keys, dimension, max_broadcast_groups)


def _with_totals(per_entity: DataFrame, totals: DataFrame, keys: list[str], dimension: str, max_broadcast_groups: int) -> DataFrame:
    """Gold rows: the accounts of each group with the group's number of accounts."""
    hinted, small = broadcast_if_bounded(totals, max_broadcast_groups)
    if small:
        joined = per_entity.join(hinted, keys, "inner")
    else:
        joined = split_hot_join(materialize(per_entity), totals, keys, "inner")
    out = [
        "week_of_month",
        "week_of_year",
        dimension,
        "unique_safes",
        "safe_account",
        "total_transactions_per_safe",
        "total_amount_usd_per_safe",
    ]
    out += [c for c in PARTITION_KEYS if c in keys]
    return joined.select(*out)


def day_states(silver: DataFrame, dimension: str, entity_col: str = "tx_hash", amount_col: str = "amount_usd") -> DataFrame:
    """Mergeable partial states: per day, week, dimension and account, its transactions and money.

    States of different days add up to the gold rows of their weeks
    (``gold_of_states``). Money is kept wide, so a sum that overflows the gold
    column does so only when the week is built, as in ``weekly_activity``.
    """
    keys = ["block_date", *_group_keys(silver, dimension)]
    base = silver.select(*keys, F.col(entity_col).alias("safe_account"), F.col(amount_col).try_cast(MONEY).alias("amount"))
    return base.groupBy(*keys, "safe_account").agg(
        F.count("safe_account").alias("n"), F.sum("amount").cast("decimal(38,2)").alias("amount")
    )


def gold_of_states(
    states: DataFrame, dimension: str, *, max_broadcast_groups: int = DEFAULT_BROADCAST_ROWS
) -> DataFrame:
    """The gold rows of whole weeks from all their days' states."""
    keys = _group_keys(states, dimension)
    # one merge of the states feeds the accounts' rows and their number
    per_entity = materialize(
        states.groupBy(*keys, "safe_account").agg(
            F.sum("n").alias("total_transactions_per_safe"),
            F.sum("amount").try_cast(MONEY).alias("total_amount_usd_per_safe"),
        )
    )
    totals = materialize(per_entity.groupBy(*keys).agg(F.count("safe_account").alias("unique_safes")))
    return _with_totals(per_entity, totals, keys, dimension, max_broadcast_groups)


def unique_accounts(silver: DataFrame, dimension: str, entity_col: str = "tx_hash") -> DataFrame:
    """Distinct non-NULL accounts per (week keys, dimension)."""
    keys = _group_keys(silver, dimension)
    return (
        silver.select(*keys, F.col(entity_col).alias("safe_account"))
        .groupBy(*keys)
        .agg(F.count_distinct("safe_account").alias("unique_safes"))
    )


def with_partition_literals(df: DataFrame, year: int, month: int) -> DataFrame:
    """Stamp ``year`` and ``month`` as int literals (the slice's partition)."""
    return df.withColumns({"year": F.lit(int(year)).cast("int"), "month": F.lit(int(month)).cast("int")})


def _group_keys(silver: DataFrame, dimension: str) -> list[str]:
    cols = set(silver.columns)
    return [c for c in PARTITION_KEYS if c in cols] + list(WEEK_KEYS) + [dimension]
