"""Result comparison: additive fingerprints first, bag difference of what differs.

Every row has a 64-bit hash. A frame's rows fall into buckets by that hash,
and a bucket's fingerprint is its row count and the sums of that hash and of a
second one (sums, so that copies count and order doesn't). Two frames are
compared by their fingerprints, one aggregation of each with partial sums in
the tasks: equal frames move a few numbers a bucket and no rows. Only rows of
buckets that differ go to ``exceptAll``. Buckets of different rows with equal
count and both sums (about one in 2**128) would go unseen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of a fingerprint; at most as many rows reach the driver.
BUCKETS = 4096


def _bucket(cols: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in cols)), F.lit(buckets)).cast("int")


def fingerprints(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n, and the sums of two hashes of its rows."""
    cols = df.columns
    second = F.xxhash64(F.lit("second"), *(F.col(f"`{c}`") for c in reversed(cols)))
    hashed = df.select(
        _bucket(cols, buckets).alias("bucket"),
        F.xxhash64(*(F.col(f"`{c}`") for c in cols)).cast("decimal(20,0)").alias("one"),
        second.cast("decimal(20,0)").alias("two"),
    )
    return hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("one").alias("one"), F.sum("two").alias("two"))


def differing_buckets(actual: DataFrame, expected: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Buckets whose fingerprints differ (frames of the same columns and types)."""
    sides = [fingerprints(df, buckets).select("bucket", "n", "one", "two", F.lit(side).alias("side")) for side, df in ((1, actual), (-1, expected))]
    both = sides[0].unionByName(sides[1])
    gap = both.groupBy("bucket").agg(*(F.sum(F.col(c) * F.col("side")).alias(c) for c in ("n", "one", "two")))
    rows = gap.where((F.col("n") != 0) | (F.col("one") != 0) | (F.col("two") != 0)).select("bucket").collect()
    return sorted(r["bucket"] for r in rows)


def same_rows(actual: DataFrame, expected: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows that differ between two frames, as a multiset, with a ``side`` column.

    ``side`` is ``"actual_only"`` for rows (or extra copies of rows) found
    only in ``actual``, ``"expected_only"`` for the reverse. Empty when both
    hold the same rows with the same multiplicities. Columns are matched by
    name (``expected`` is reordered to ``actual``'s columns) and compared in
    their common type. The fingerprints are computed when this is called.
    """
    cols = [f"`{c}`" for c in actual.columns]
    exp = expected.select(*cols)
    common = actual.limit(0).union(exp.limit(0)).schema
    a, e = (df.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in common)) for df in (actual, exp))
    differ = differing_buckets(a, e, buckets)
    if not differ:
        return a.limit(0).select(F.lit("").alias("side"), *cols)
    if len(differ) < buckets:
        here = _bucket(a.columns, buckets).isin(differ)
        a, e = a.where(here), e.where(here)
    more = a.exceptAll(e).select(F.lit("actual_only").alias("side"), *cols)
    fewer = e.exceptAll(a).select(F.lit("expected_only").alias("side"), *cols)
    return more.unionByName(fewer)


def assert_same_rows(actual: DataFrame, expected: DataFrame, show: int = 10) -> None:
    """Raise ``AssertionError`` listing a few differing rows, if any."""
    diff = same_rows(actual, expected)
    bad = diff.take(show)
    if bad:
        lines = "\n".join(str(r) for r in bad)
        raise AssertionError(f"frames differ (first {len(bad)} differing rows):\n{lines}")
