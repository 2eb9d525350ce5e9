"""Calendar columns (column in, column out), all JVM-side built-ins.

Three week conventions meet in this data:

* ``week_of_year``: ISO 8601 (weeks start Monday, week 1 holds Jan 4th).
* ``week_of_month(d, "sunday")``: weeks start Sunday and week 1 is the
  partial week holding the 1st; this is what pattern ``W`` gave under the
  legacy date parser.
* ``week_of_month(d, "monday")``: the same with weeks starting Monday, as a
  month calendar printed with Monday first numbers its rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chainfold.functions import as_col


def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """String to date with an explicit pattern (NULL if it does not parse)."""
    return F.try_to_timestamp(as_col(c), F.lit(fmt)).cast("date")


def year(c) -> Column:
    return F.year(as_col(c))


def month(c) -> Column:
    return F.month(as_col(c))


def day_of_month(c) -> Column:
    return F.dayofmonth(as_col(c))


def week_of_year(c) -> Column:
    """ISO week number."""
    return F.weekofyear(as_col(c))


def week_of_month(c, start: str = "sunday") -> Column:
    """Week number inside the month; week 1 holds the 1st.

    ``start`` is the first day of a week: ``"sunday"`` or ``"monday"``.
    The offset is the weekday of the month's first day counted from
    ``start``, so the 1st sits in column ``offset`` of week 1.
    """
    d = as_col(c)
    first = F.trunc(d, "MM")
    if start == "sunday":
        offset = F.dayofweek(first) - 1  # dayofweek: Sunday = 1
    elif start == "monday":
        offset = F.weekday(first)  # weekday: Monday = 0
    else:
        raise ValueError(f"start must be 'sunday' or 'monday', not {start!r}")
    return (F.floor((F.dayofmonth(d) - 1 + offset) / 7) + 1).cast("int")


def previous_day(c) -> Column:
    return F.date_sub(as_col(c), 1)


def date_string_parts(c) -> tuple[Column, Column]:
    """Year and month as ints from a ``YYYY-MM-DD`` string, by splitting."""
    parts = F.split(as_col(c), "-")
    return parts.getItem(0).try_cast("int"), parts.getItem(1).try_cast("int")


def with_calendar(df, date_col: str = "block_date", week_start: str = "sunday"):
    """Add year, month, ISO week and week-of-month columns for ``date_col``."""
    d = F.col(date_col)
    return df.withColumns(
        {
            "year": year(d),
            "month": month(d),
            "week_of_year": week_of_year(d),
            "week_of_month": week_of_month(d, week_start),
        }
    )
