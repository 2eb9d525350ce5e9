"""Silver layer: clean one or many days of labelled transfers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from chainfold.functions.calendar import parse_date, with_calendar
from chainfold.schemas import SILVER

SILVER_INPUT = ("token_category", "event_name", "tx_hash", "vertical", "protocol", "amount_usd")
SILVER_ORDER = tuple(SILVER.fieldNames())
REQUIRED = ("tx_hash", "vertical", "protocol")


def quarantine(
    df: DataFrame,
    block_date: str | None = None,
    event_name: str = "Transfer",
    dedupe_keys: Sequence[str] | None = None,
    week_start: str = "sunday",
) -> DataFrame:
    """Filter, de-duplicate and add calendar columns.

    Keeps rows whose ``event_name`` equals ``event_name``, whose
    ``amount_usd`` is a positive number and whose tx_hash, vertical and
    protocol are set; drops exact duplicates; adds block_date, year, month,
    ISO week and week of month.

    ``block_date``: a ``YYYY-MM-DD`` string stamps every row with that day
    (the input is one day); ``None`` keeps each row's own ``block_date``, so
    many days are cleaned in one job and a row is only a duplicate of a row
    of the same day. A row that is kept but has no valid date fails the job:
    it would belong to no month.

    ``amount_usd`` is cast to double before it is compared, so a string
    column read from CSV is compared as a number; the other columns are cast
    to string (the silver schema).

    ``dedupe_keys`` restricts de-duplication to those columns (default: all
    output columns, i.e. whole-row ``distinct``).
    """
    amount = F.col("amount_usd").try_cast("double")
    if block_date is None:
        own = F.col("block_date").try_cast("date")
        text = F.coalesce(F.col("block_date").cast("string"), F.lit("NULL"))
        day = F.when(own.isNotNull(), own).otherwise(F.raise_error(F.concat(F.lit("block_date is not a date: "), text)))
    else:
        day = parse_date(F.lit(str(block_date)))
    cleaned = (
        df.select(
            *[F.col(c).cast("string").alias(c) for c in SILVER_INPUT[:5]],
            amount.alias("amount_usd"),
            day.alias("block_date"),
        )
        .where(F.col("event_name") == F.lit(event_name))
        .where(F.col("amount_usd") > 0)
        .where(F.col("tx_hash").isNotNull() & F.col("vertical").isNotNull() & F.col("protocol").isNotNull())
    )
    cleaned = cleaned.dropDuplicates(list(dedupe_keys)) if dedupe_keys else cleaned.distinct()
    return with_calendar(cleaned, "block_date", week_start).select(*SILVER_ORDER)


REASONS = ("other event", "amount not positive", "missing tx_hash, vertical or protocol")


def reject_reason(event_name: str = "Transfer") -> Column:
    """Why ``quarantine`` drops a row (the first rule that it fails), NULL if it doesn't."""
    kept_event = F.coalesce(F.col("event_name").cast("string") == F.lit(event_name), F.lit(False))
    positive = F.coalesce(F.col("amount_usd").try_cast("double") > 0, F.lit(False))
    complete = F.col("tx_hash").isNotNull() & F.col("vertical").isNotNull() & F.col("protocol").isNotNull()
    return F.when(~kept_event, F.lit(REASONS[0])).when(~positive, F.lit(REASONS[1])).when(~complete, F.lit(REASONS[2]))


@dataclass
class Accounting:
    """Row counts of one cleaning pass, filled by the first action on its result."""

    before: Observation
    after: Observation

    @property
    def counts(self) -> dict[str, int]:
        """Rows by outcome: the reasons, "duplicate" and "kept"; they add up to the rows read.

        Waits for the action that reads the cleaned rows."""
        seen, kept = self.before.get, self.after.get["kept"]
        out = {reason: seen[f"r{i}"] for i, reason in enumerate(REASONS)}
        return out | {"duplicate": seen["rows"] - sum(out.values()) - kept, "kept": kept}


def quarantine_counted(df: DataFrame, block_date: str | None = None, event_name: str = "Transfer", **kw) -> tuple[DataFrame, Accounting]:
    """``quarantine`` and what it drops, counted by reason while the rows pass (no second scan)."""
    name = uuid.uuid4().hex[:8]
    accounting = Accounting(Observation(f"before-{name}"), Observation(f"after-{name}"))
    reason = reject_reason(event_name)
    counted = df.observe(
        accounting.before,
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(F.coalesce(reason == r, F.lit(False))).alias(f"r{i}") for i, r in enumerate(REASONS)),
    )
    clean = quarantine(counted, block_date, event_name, **kw)
    return clean.observe(accounting.after, F.count(F.lit(1)).alias("kept")), accounting


def filter_event(df: DataFrame, event_name: str = "Transfer") -> DataFrame:
    """Rows of that event; NULL is none."""
    return df.where(F.col("event_name") == F.lit(event_name))


def filter_positive(df: DataFrame, col: str = "amount_usd") -> DataFrame:
    """Rows whose numeric value of ``col`` is above 0; NULL and text are not."""
    return df.where(F.col(col).try_cast("double") > 0)


def filter_required(df: DataFrame, cols: Sequence[str] = REQUIRED) -> DataFrame:
    """All of ``cols`` are not NULL (NaN is kept, unlike ``na.drop``)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)
