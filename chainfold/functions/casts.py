"""Numeric casts with explicit overflow and truncation behaviour."""

from __future__ import annotations

from pyspark.sql import Column

from chainfold.functions import as_col
from chainfold.schemas import MONEY


def to_money(c) -> Column:
    """decimal(15,2), rounding half up; NULL on overflow instead of an error."""
    return as_col(c).try_cast(MONEY)


def to_int_truncated(c) -> Column:
    """Float to int by truncation toward zero (NULL if out of range)."""
    return as_col(c).try_cast("int")


def to_long(c) -> Column:
    """String or number to bigint (NULL if it does not parse)."""
    return as_col(c).try_cast("bigint")
