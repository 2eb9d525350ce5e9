"""Top-k over a gold table.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: each task
keeps its own k best rows and only those reach the final merge, so no full
sort happens. The aggregate before it is partial + final.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURES = {
    "total_transactions_per_safe": "highest_transaction_count",
    "total_amount_usd_per_safe": "highest_transaction_volume",
}


def top_k(
    gold: DataFrame,
    dimension: str,
    measure: str,
    k: int = 5,
    *,
    year: int | None = None,
    month: int | None = None,
    alias: str | None = None,
) -> DataFrame:
    """The ``k`` values of ``dimension`` with the largest ``sum(measure)``.

    Ties are broken by ``dimension`` ascending, so the answer is stable.
    ``year``/``month`` restrict the input to one partition (pruned at the
    scan when ``gold`` is a partitioned table); by default all are read.
    """
    name = alias or MEASURES.get(measure, f"sum_{measure}")
    df = gold
    if year is not None:
        df = df.where(F.col("year") == F.lit(int(year)))
    if month is not None:
        df = df.where(F.col("month") == F.lit(int(month)))
    summed = df.groupBy(dimension).agg(F.sum(measure).alias(name))
    return summed.orderBy(F.col(name).desc_nulls_last(), F.col(dimension).asc_nulls_last()).limit(k)


def sum_by(gold: DataFrame, dimension: str, measure: str, alias: str | None = None) -> DataFrame:
    """``SELECT dimension, sum(measure) ... GROUP BY 1`` (every group)."""
    name = alias or MEASURES.get(measure, f"sum_{measure}")
    return gold.groupBy(dimension).agg(F.sum(measure).alias(name))
