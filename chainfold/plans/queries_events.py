"""Queries over the ``events`` mapping: silver, gold, top-k and the single
operators they are made of (SURVEY §2 keys C, E, G, H, I, J10-J15, J17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chainfold.operators import gold as G
from chainfold.operators.joins import materialize
from chainfold.operators.labels import label_transfers
from chainfold.operators.silver import REASONS, quarantine, quarantine_counted
from chainfold.operators.topk import top_k
from chainfold.plans import oracle as O
from chainfold.plans.registry import query
from chainfold.plans.testdata import event_transfers, label_inputs
from chainfold.schemas import SILVER
from chainfold.session import scratch_dir
from chainfold.sinks.files import write_partitions
from chainfold.sources.files import read_table


def silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(event_transfers(spark, sf_dir))


def gold_of(spark: SparkSession, sf_dir: str, dim: str) -> DataFrame:
    """Gold from silver, with silver materialized first, as the flow reads
    gold's input from the stored silver table (one silver computation feeds
    the size probe and both aggregation branches)."""
    return G.weekly_activity(materialize(silver_of(spark, sf_dir)), dim)


# ------------------------------------------------------------------ J10-J15

_SILVER_SQL = O.with_(O.EVENTS, O.SILVER) + "\nSELECT * FROM silver"


@query("quarantine", _SILVER_SQL)
def q_quarantine(spark, sf_dir):
    return silver_of(spark, sf_dir)


@query(
    "quarantine_counts",
    O.with_(O.EVENTS, O.SILVER)
    + f"""
, told AS (SELECT CASE WHEN event_name = 'Transfer' THEN CASE WHEN amount_usd > 0 THEN
    CASE WHEN len(list_filter([tx_hash, vertical, protocol], lambda x: x IS NULL)) = 0 THEN 'clean' ELSE '{REASONS[2]}' END
    ELSE '{REASONS[1]}' END ELSE '{REASONS[0]}' END AS outcome FROM transfers_ev)
SELECT outcome, COUNT(*) AS n FROM told WHERE outcome <> 'clean' GROUP BY outcome
UNION ALL SELECT 'kept', (SELECT COUNT(*) FROM silver)
UNION ALL SELECT 'duplicate', (SELECT COUNT(*) FROM told WHERE outcome = 'clean') - (SELECT COUNT(*) FROM silver)""",
)
def q_quarantine_counts(spark, sf_dir):
    """What the cleaning pass keeps and drops, by reason; adds up to its input."""
    clean, accounting = quarantine_counted(event_transfers(spark, sf_dir))
    materialize(clean)
    return spark.createDataFrame(list(accounting.counts.items()), "outcome string, n long")


@query("gold_vertical", O.with_(O.EVENTS, O.SILVER, O.gold("vertical")) + "\nSELECT * FROM gold_vertical")
def q_gold_vertical(spark, sf_dir):
    return gold_of(spark, sf_dir, "vertical")


@query("gold_protocol", O.with_(O.EVENTS, O.SILVER, O.gold("protocol")) + "\nSELECT * FROM gold_protocol")
def q_gold_protocol(spark, sf_dir):
    return gold_of(spark, sf_dir, "protocol")


def _topk_sql(dim: str, measure: str) -> str:
    return O.with_(O.EVENTS, O.SILVER, O.gold(dim)) + "\n" + O.topk(dim, measure)


def _register_topk(dim: str, measure: str) -> None:
    col = "total_transactions_per_safe" if measure == "count" else "total_amount_usd_per_safe"

    @query(f"topk_{dim}_{measure}", _topk_sql(dim, measure))
    def _q(spark, sf_dir):
        return top_k(gold_of(spark, sf_dir, dim), dim, col, 5)


for _dim in ("vertical", "protocol"):
    for _m in ("count", "volume"):
        _register_topk(_dim, _m)


# ------------------------------------------------------ single operators

from pyspark.sql import functions as F  # noqa: E402

from chainfold.functions import calendar as C  # noqa: E402
from chainfold.functions.casts import to_int_truncated, to_long, to_money  # noqa: E402
from chainfold.operators.compare import same_rows  # noqa: E402
from chainfold.operators.silver import filter_event, filter_positive, filter_required  # noqa: E402
from chainfold.operators.topk import sum_by  # noqa: E402
from chainfold.plans.testdata import table  # noqa: E402

_EV = O.with_(O.EVENTS)
_EV_SILVER = O.with_(O.EVENTS, O.SILVER)
_EV_COLS = "tx_hash, event_name, vertical, protocol, amount_usd, token_category, block_date"


def _ev(spark, sf_dir):
    return event_transfers(spark, sf_dir)


@query("project_columns", _EV + "\nSELECT token_category, event_name, tx_hash, vertical, protocol, amount_usd FROM transfers_ev")
def q_project_columns(spark, sf_dir):
    return _ev(spark, sf_dir).select("token_category", "event_name", "tx_hash", "vertical", "protocol", "amount_usd")


@query("drop_column", _EV + "\nSELECT tx_hash, event_name, vertical, protocol, amount_usd, token_category FROM transfers_ev")
def q_drop_column(spark, sf_dir):
    return _ev(spark, sf_dir).drop("block_date")


@query(
    "project_exprs",
    _EV_SILVER
    + """
SELECT tx_hash AS safe_account, block_date, week_of_month, week_of_year, vertical, protocol,
       CAST(amount_usd AS DECIMAL(15,2)) AS amount_usd FROM silver""",
)
def q_project_exprs(spark, sf_dir):
    silver = silver_of(spark, sf_dir)
    weeks_and_names = [F.col(c) for c in ("block_date", "week_of_month", "week_of_year", "vertical", "protocol")]
    return silver.select(F.col("tx_hash").alias("safe_account"), *weeks_and_names, to_money("amount_usd").alias("amount_usd"))


@query("rename_columns", _EV + "\nSELECT tx_hash AS safe_account, vertical AS business_vertical, amount_usd FROM transfers_ev")
def q_rename_columns(spark, sf_dir):
    df = _ev(spark, sf_dir).withColumnsRenamed({"tx_hash": "safe_account", "vertical": "business_vertical"})
    return df.select("safe_account", "business_vertical", "amount_usd")


@query(
    "literal_columns",
    _EV + "\nSELECT tx_hash, block_date, CAST(2024 AS INTEGER) AS year, CAST(1 AS INTEGER) AS month,"
    " DATE '2024-01-31' AS run_date FROM transfers_ev",
)
def q_literal_columns(spark, sf_dir):
    df = G.with_partition_literals(_ev(spark, sf_dir).select("tx_hash", "block_date"), 2024, 1)
    return df.withColumn("run_date", F.lit("2024-01-31").cast("date"))


@query("cast_decimal", _EV + "\nSELECT tx_hash, amount_usd, CAST(amount_usd AS DECIMAL(15,2)) AS amount_money FROM transfers_ev")
def q_cast_decimal(spark, sf_dir):
    df = _ev(spark, sf_dir)
    return df.select("tx_hash", "amount_usd", to_money("amount_usd").alias("amount_money"))


@query("star_plus_computed", _EV + f"\nSELECT {_EV_COLS}, amount_usd > 0 AS is_positive FROM transfers_ev")
def q_star_plus_computed(spark, sf_dir):
    return _ev(spark, sf_dir).withColumn("is_positive", F.col("amount_usd") > 0)


@query("filter_equal_not_null", _EV + "\nSELECT * FROM transfers_ev WHERE event_name IN ('Transfer')")
def q_filter_equal_not_null(spark, sf_dir):
    return filter_event(_ev(spark, sf_dir))


@query("filter_positive", _EV + "\nSELECT * FROM transfers_ev WHERE sign(amount_usd) = 1")
def q_filter_positive(spark, sf_dir):
    return filter_positive(_ev(spark, sf_dir))


@query(
    "filter_required_columns",
    _EV + "\nSELECT * FROM transfers_ev WHERE len(list_filter([tx_hash, vertical, protocol], lambda x: x IS NULL)) = 0",
)
def q_filter_required_columns(spark, sf_dir):
    return filter_required(_ev(spark, sf_dir))


@query(
    "filter_partition",
    O.with_(O.LABEL_INPUTS, O.SAFE_TRANSFERS, O.RECEIVER_FACTS, O.LABELLED, O.SILVER_L) + "\nSELECT * FROM silver_l WHERE year = 1997 AND month = 3",
)
def q_filter_partition(spark, sf_dir):
    """One partition of a written table of many months."""
    path = scratch_dir(spark, "silver")
    write_partitions(quarantine(label_transfers(label_inputs(spark, sf_dir)), event_name="A"), path)
    return read_table(spark, path, SILVER).where("year = 1997 AND month = 3")


@query(
    "agg_distinct_count",
    _EV_SILVER
    + """
SELECT year, month, week_of_month, week_of_year, vertical, COUNT(DISTINCT tx_hash) AS unique_safes
FROM silver GROUP BY year, month, week_of_month, week_of_year, vertical""",
)
def q_agg_distinct_count(spark, sf_dir):
    return G.unique_accounts(silver_of(spark, sf_dir), "vertical")


@query(
    "agg_count_sum",
    O.with_(O.EVENTS, O.SILVER, O.gold("vertical")) + "\nSELECT * FROM pe_vertical",
)
def q_agg_count_sum(spark, sf_dir):
    return G.per_entity_totals(silver_of(spark, sf_dir), "vertical")[0]


@query(
    "join_inner_using",
    O.with_(O.EVENTS, O.SILVER, O.gold("protocol"))
    + """
SELECT p.*, u.unique_safes FROM pe_protocol p
JOIN (SELECT year, month, week_of_month, week_of_year, protocol, COUNT(DISTINCT tx_hash) AS unique_safes
      FROM silver GROUP BY ALL) u USING (year, month, week_of_month, week_of_year, protocol)""",
)
def q_join_inner_using(spark, sf_dir):
    s = silver_of(spark, sf_dir)
    per_entity, keys = G.per_entity_totals(s, "protocol")
    return per_entity.join(G.unique_accounts(s, "protocol"), keys, "inner")


@query(
    "agg_sum_by_ordinal",
    O.with_(O.EVENTS, O.SILVER, O.gold("vertical"))
    + "\nSELECT vertical, CAST(SUM(total_transactions_per_safe) AS BIGINT) AS highest_transaction_count"
    " FROM gold_vertical GROUP BY 1",
)
def q_agg_sum_by_ordinal(spark, sf_dir):
    gold = gold_of(spark, sf_dir, "vertical")
    return spark.sql(
        "SELECT vertical, sum(total_transactions_per_safe) AS highest_transaction_count FROM {g} GROUP BY 1",
        g=gold,
    )


@query(
    "sum_by_dimension",
    O.with_(O.EVENTS, O.SILVER, O.gold("protocol"))
    + "\nSELECT protocol, CAST(SUM(total_amount_usd_per_safe) AS DECIMAL(25,2)) AS highest_transaction_volume"
    " FROM gold_protocol GROUP BY protocol",
)
def q_sum_by_dimension(spark, sf_dir):
    return sum_by(gold_of(spark, sf_dir, "protocol"), "protocol", "total_amount_usd_per_safe")


def _register_account_topk(key: str, measure: str) -> None:
    m = "count" if measure == "total_transactions_per_safe" else "volume"
    sql = O.with_(O.EVENTS, O.SILVER, O.gold("vertical")) + "\n" + O.topk("safe_account", m, 5, src="gold_vertical")

    @query(key, sql)
    def _q(spark, sf_dir):
        return top_k(gold_of(spark, sf_dir, "vertical"), "safe_account", measure, 5)


_register_account_topk("topk_by_count", "total_transactions_per_safe")
_register_account_topk("topk_by_volume", "total_amount_usd_per_safe")


@query(
    "single_value",
    _EV + "\nSELECT MIN(block_date) AS first_day, MAX(block_date) AS last_day,"
    " COUNT(DISTINCT block_date) AS n_days FROM transfers_ev",
)
def q_single_value(spark, sf_dir):
    return _ev(spark, sf_dir).agg(
        F.min("block_date").alias("first_day"),
        F.max("block_date").alias("last_day"),
        F.count_distinct("block_date").alias("n_days"),
    )


@query("drop_duplicates", _EV + "\nSELECT DISTINCT * FROM transfers_ev")
def q_drop_duplicates(spark, sf_dir):
    return _ev(spark, sf_dir).dropDuplicates()


@query("sort_global", _EV_SILVER + "\nSELECT * FROM silver ORDER BY block_date, tx_hash")
def q_sort_global(spark, sf_dir):
    return silver_of(spark, sf_dir).orderBy("block_date", "tx_hash")


@query("limit_zero", _EV_SILVER + "\nSELECT * FROM silver LIMIT 0")
def q_limit_zero(spark, sf_dir):
    return silver_of(spark, sf_dir).limit(0)


@query(
    "nth_smallest",
    """SELECT CAST(trunc(value) AS INTEGER) AS id FROM (SELECT DISTINCT value, event_type FROM events)
ORDER BY 1 LIMIT 1 OFFSET 2""",
)
def q_nth_smallest(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("value", "event_type").dropDuplicates()
    ints = ev.select(to_int_truncated("value").alias("id"))
    return ints.orderBy("id").offset(2).limit(1)


_REORDERED = ["block_date", "amount_usd", "token_category", "protocol", "vertical", "event_name", "tx_hash"]


@query("union_by_name", _EV + f"\nSELECT {_EV_COLS} FROM transfers_ev UNION ALL SELECT {_EV_COLS} FROM transfers_ev")
def q_union_by_name(spark, sf_dir):
    a = _ev(spark, sf_dir)
    return a.unionByName(a.select(*_REORDERED))


@query("union_distinct", _EV + f"\nSELECT {_EV_COLS} FROM transfers_ev UNION SELECT {_EV_COLS} FROM transfers_ev")
def q_union_distinct(spark, sf_dir):
    a = _ev(spark, sf_dir)
    return a.unionByName(a.select(*_REORDERED)).dropDuplicates()


@query(
    "except_all",
    _EV + f"\nSELECT {_EV_COLS} FROM transfers_ev EXCEPT ALL SELECT DISTINCT {_EV_COLS} FROM transfers_ev",
)
def q_except_all(spark, sf_dir):
    a = _ev(spark, sf_dir)
    return a.exceptAll(a.distinct())


@query(
    "same_rows",
    _EV
    + f"""
SELECT 'actual_only' AS side, * FROM (SELECT {_EV_COLS} FROM transfers_ev
  EXCEPT ALL SELECT DISTINCT {_EV_COLS} FROM transfers_ev)
UNION ALL
SELECT 'expected_only' AS side, * FROM (SELECT DISTINCT {_EV_COLS} FROM transfers_ev
  EXCEPT ALL SELECT {_EV_COLS} FROM transfers_ev)""",
)
def q_same_rows(spark, sf_dir):
    a = _ev(spark, sf_dir)
    return same_rows(a, a.distinct())


@query(
    "cast_numeric",
    """SELECT event_id, CAST(trunc(value) AS INTEGER) AS value_int,
  CAST(CAST(user_id AS VARCHAR) AS BIGINT) AS user_long,
  TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_long FROM events""",
)
def q_cast_numeric(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        to_int_truncated("value").alias("value_int"),
        to_long(F.col("user_id").cast("string")).alias("user_long"),
        to_long(F.get_json_object("props", "$.k")).alias("k_long"),
    )


# Calendar functions over ship dates (1995-2001): thousands of distinct days,
# so both week-of-month conventions and ISO week edge cases are exercised.
_SHIP = "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d FROM lineitem"


def _ship(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("d"))


def _register_calendar(key: str, spark_cols, sql_cols: str) -> None:
    @query(key, f"WITH s AS ({_SHIP})\nSELECT l_orderkey, l_linenumber, d, {sql_cols} FROM s")
    def _q(spark, sf_dir):
        s = _ship(spark, sf_dir)
        return s.select("l_orderkey", "l_linenumber", "d", *spark_cols(F.col("d")))


_register_calendar(
    "parse_date",
    lambda d: [C.parse_date(F.date_format(d, "yyyy-MM-dd")).alias("parsed")],
    "CAST(strptime(strftime(d, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS parsed",
)
_register_calendar(
    "date_year_month",
    lambda d: [C.year(d).alias("year"), C.month(d).alias("month")],
    "CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month",
)
_register_calendar("date_iso_week", lambda d: [C.week_of_year(d).alias("week_of_year")], "CAST(weekofyear(d) AS INTEGER) AS week_of_year")
_register_calendar("date_day", lambda d: [C.day_of_month(d).alias("day")], "CAST(dayofmonth(d) AS INTEGER) AS day")
_register_calendar(
    "week_of_month_sunday",
    lambda d: [C.week_of_month(d, "sunday").alias("week_of_month")],
    O.week_of_month_sql("d", "sunday") + " AS week_of_month",
)
_register_calendar(
    "week_of_month_monday",
    lambda d: [C.week_of_month(d, "monday").alias("week_of_month")],
    O.week_of_month_sql("d", "monday") + " AS week_of_month",
)
_register_calendar("date_minus_day", lambda d: [C.previous_day(d).alias("previous_day")], "CAST(d - INTERVAL 1 DAY AS DATE) AS previous_day")
_register_calendar(
    "date_string_parts",
    lambda d: list(
        (c.alias(n) for c, n in zip(C.date_string_parts(F.date_format(d, "yyyy-MM-dd")), ("year", "month"), strict=True))
    ),
    "CAST(split_part(strftime(d, '%Y-%m-%d'), '-', 1) AS INTEGER) AS year,"
    " CAST(split_part(strftime(d, '%Y-%m-%d'), '-', 2) AS INTEGER) AS month",
)
