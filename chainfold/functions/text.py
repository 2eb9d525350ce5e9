"""String and NULL-handling column functions used by the label step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chainfold.functions import as_col


def lower(c) -> Column:
    return F.lower(as_col(c))


def trim(c) -> Column:
    return F.trim(as_col(c))


def concat_strict(*parts) -> Column:
    """SQL ``CONCAT``: NULL as soon as one part is NULL."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def first_part(c, sep: str) -> Column:
    """Text before the first ``sep``; the whole string if ``sep`` is absent."""
    return F.split_part(as_col(c), F.lit(sep), F.lit(1))


def first_non_null(*cols) -> Column:
    return F.coalesce(*[as_col(c) for c in cols])


def contains_like(c, pattern: str) -> Column:
    """SQL ``LIKE`` (``_`` and ``%`` are wildcards)."""
    return as_col(c).like(pattern)
