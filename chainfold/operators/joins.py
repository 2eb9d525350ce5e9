"""Join helpers: size-checked broadcast, joins that split hot keys, flag joins.

A side is broadcast only after a run-time check has counted its rows and the
bytes of its strings; the check is one aggregation, of which each task sends
one row. It is applied to input lists (wallets, stablecoins) and to
materialized intermediates, never to an unmaterialized plan that would be
computed twice. Beyond the bound the join is a shuffle join. There, keys that
hold a thousandth of the rows or more are found by ``hot_keys``, which shuffles
a few thousand counts a task instead of the keys; at most a thousand keys can.
Their rows are joined with a broadcast of just those keys' rows of the other
side, so a hot key is spread over all tasks and nothing is copied for the
others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainfold.storage import write_intermediate

# Broadcast bounds: rows, and bytes of the columns' values.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20
# A key is hot from one part in this many of all rows.
HOT_PARTS = 1000
# Bits of ``key_filter`` for each row of the keys, and the most that there are (a broadcast of 38 MB).
FILTER_BITS_PER_ROW = 16
MAX_FILTER_BITS = 1 << 28
# Hash buckets of the first count, for each part: a bucket of cold keys holds about an eighth of a hot key's rows.
BUCKETS_PER_PART = 8


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True if ``df`` has no more than ``max_rows`` rows and ``max_bytes`` bytes
    (strings by their length, other columns as 8 bytes)."""
    width = F.lit(0)
    for name, kind in df.dtypes:
        width = width + (F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)) if kind == "string" else F.lit(8))
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(width.cast("long")).alias("bytes")).first()
    return row["rows"] <= max_rows and (row["bytes"] or 0) <= max_bytes


def broadcast_if_bounded(
    df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, probe: DataFrame | None = None
) -> tuple[DataFrame, bool]:
    """Return ``(df with broadcast hint, True)`` if the bound holds, else ``(df, False)``.

    ``probe`` is a cheaper frame with at least as many rows as ``df`` (for
    example the distinct group keys on a pruned scan); it is counted in place
    of ``df`` when given.
    """
    if has_at_most(probe if probe is not None else df, max_rows):
        return F.broadcast(df), True
    return df, False


def _same(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"big.{k}").eqNullSafe(F.col(f"small.{k}"))
    return cond


def hot_keys(df: DataFrame, on: Sequence[str], parts: int = HOT_PARTS) -> DataFrame | None:
    """Keys that hold at least one part in ``parts`` of the rows of ``df`` (NULL is a key), None if there is none.

    Rows are counted by hash bucket first. A bucket that holds less than a part
    has no hot key, so only the keys of the others are counted one by one. In a
    table of up to ``parts`` rows no key is hot.
    """
    bucket = F.pmod(F.xxhash64(*on), F.lit(parts * BUCKETS_PER_PART))
    counted = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["n"] for r in counted)
    full = [r["bucket"] for r in counted if r["n"] * parts >= total]
    if total <= parts or not full:
        return None
    counts = df.where(bucket.isin(full)).groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    hot = write_intermediate(counts.where(F.col("n") * parts >= total).select(*on), "hot-keys")
    return None if hot.isEmpty() else hot


def key_filter(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` may occur in ``keys``: all of those that do, few of the others.

    A bit per hash of a key, in rows of eight words, is broadcast to where ``df``
    is read, so that a semi join that follows shuffles little more than it keeps.
    Beyond ``MAX_FILTER_BITS`` keys, or with keys of different types, whose hashes
    differ, ``df`` comes back whole. ``keys`` is read twice. NULL occurs in nothing.
    """
    if dict(df.dtypes)[on] != dict(keys.dtypes)[on]:
        return df
    rows = keys.count()
    if rows > MAX_FILTER_BITS:
        return df
    bits = min(MAX_FILTER_BITS, 1 << max(20, (rows * FILTER_BITS_PER_ROW).bit_length()))
    slot = F.pmod(F.xxhash64(on), F.lit(bits))
    word, bit = F.pmod(F.shiftright(slot, 6), F.lit(8)).cast("int"), F.pmod(slot, F.lit(64)).cast("int")
    held = keys.where(F.col(on).isNotNull()).select(F.shiftright(slot, 9).alias("__block"), word.alias("word"), F.expr("1L").alias("one"), bit.alias("bit"))
    mask = F.expr("shiftleft(one, bit)")
    words = [f"__word{i}" for i in range(8)]
    blocks = held.groupBy("__block").agg(*[F.bit_or(F.when(F.col("word") == i, mask).otherwise(F.lit(0))).alias(w) for i, w in enumerate(words)])
    found = df.where(F.col(on).isNotNull()).withColumn("__block", F.shiftright(slot, 9)).join(F.broadcast(blocks), "__block")
    return found.where(F.getbit(F.element_at(F.array(*words), word + 1), bit) == 1).select(*df.columns)


def split_hot_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str, *, null_safe: bool = False, parts: int = HOT_PARTS
) -> DataFrame:
    """Shuffle join of ``big`` with ``small`` (few rows per key) that splits hot keys of ``big``.

    ``how`` is left, inner, left_semi or left_anti; NULL keys match only with
    ``null_safe``. ``big`` is read up to four times, so it should be materialized
    or a plain scan. Columns of the same name other than the keys clash.
    """
    on = list(on)
    if not null_safe:
        small = small.dropna(subset=on)
    hot = hot_keys(big, on, parts)

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        out = left.alias("big").join(right.alias("small"), _same(on), how)
        if how in ("left_semi", "left_anti"):
            return out.select("big.*")
        rest = [F.col(f"small.`{c}`") for c in small.columns if c not in on]
        return out.select("big.*", *rest)

    if hot is None:
        return joined(big, small)

    def of_hot(df: DataFrame, kind: str) -> DataFrame:
        return df.alias("big").join(F.broadcast(hot).alias("small"), _same(on), kind).select("big.*")

    spread = joined(of_hot(big, "left_semi"), F.broadcast(of_hot(small, "left_semi")))
    return spread.unionByName(joined(of_hot(big, "left_anti"), small))


def two_sided_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", *, parts: int = HOT_PARTS
) -> DataFrame:
    """Join of two large sides that may both repeat a key; ``how`` is inner or left.

    A key is hot if it holds one part in ``parts`` of either side; at most
    twice as many keys can. The pairs of a hot key are dealt in blocks: its
    left rows go to row blocks, its right rows to column blocks of about one
    part each, and every block of pairs is a join key of its own. A left row
    is copied once per column block and a right row once per row block, which
    is small beside the pairs they make. The other keys take a plain shuffle
    join. NULL keys match nothing. Both sides are read several times, so they
    should be materialized or plain scans; columns of the same name other than
    the keys clash.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how is inner or left, not {how!r}")
    on = list(on)
    right = right.dropna(subset=on)
    sides = [left.dropna(subset=on), right]
    found = [hot for hot in (hot_keys(side, on, parts) for side in sides) if hot is not None]
    if not found:
        return left.join(right, on, how)
    either = found[0].unionByName(found[-1]).distinct()
    width = [max(1, -(-side.count() // parts)) for side in sides]
    counted = [
        side.join(F.broadcast(either), on, "left_semi").groupBy(*on).agg(F.count(F.lit(1)).alias(n))
        for side, n in zip(sides, ("rows", "columns"), strict=True)
    ]
    # a key without a partner makes no pairs and is left to the plain join
    hot = counted[0].join(counted[1], on)
    hot = write_intermediate(
        hot.select(*on, F.ceil(F.col("rows") / width[0]).cast("int").alias("__rows"), F.ceil(F.col("columns") / width[1]).cast("int").alias("__columns")),
        "hot-pairs",
    )
    if hot.isEmpty():
        return left.join(right, on, how)
    hot = F.broadcast(hot)

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        """Rows of the hot keys in a block of their side, one copy for each block of the other."""
        block = F.pmod(F.monotonically_increasing_id(), F.col(f"__{own}")).cast("int")
        spread = side.join(hot, on).withColumn(f"__{own}", block)
        return spread.withColumn(f"__{other}", F.explode(F.sequence(F.lit(0), F.col(f"__{other}") - 1)))

    blocks = [*on, "__rows", "__columns"]
    pairs = dealt(left, "rows", "columns").join(dealt(right, "columns", "rows"), blocks).drop("__rows", "__columns")
    cold = left.join(hot, on, "left_anti").join(right.join(hot, on, "left_anti"), on, how)
    return pairs.unionByName(cold)


def join_small_side(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    max_rows: int = DEFAULT_BROADCAST_ROWS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Join ``big`` to a side that is usually small, unique per key.

    Broadcast after the size check; otherwise a shuffle join that splits the
    hot keys of ``big``, which is materialized first. NULL keys match nothing.
    """
    hinted, ok = broadcast_if_bounded(small, max_rows, probe)
    if ok:
        return big.join(hinted, list(on), how)
    return split_hot_join(materialize(big), small, on, how)


def membership_flag(
    df: DataFrame, key: str, members: DataFrame, member_key: str, flag: str
) -> DataFrame:
    """Add boolean ``flag``: is ``df[key]`` one of ``members[member_key]``.

    This is ``key IN (SELECT member_key FROM members)`` used as a value
    (an existence join). Members are made distinct first so rows of ``df``
    are never multiplied. NULL keys get ``False``; inside a CASE that is the
    same as SQL's unknown.
    """
    m = (
        members.select(F.col(member_key).alias(key))
        .where(F.col(key).isNotNull())
        .distinct()
        .withColumn(flag, F.lit(True))
    )
    return join_small_side(df, m, [key], "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, as Parquet below the session's checkpoint folder.

    Later reads are pruned, and a lost executor costs no recomputation. Used
    where one intermediate result feeds several later steps or a size check.
    """
    return write_intermediate(df, "step")
