"""Verticals by a table of rules: (place, kind, name, vertical), smallest place wins.

A rule says what a receiver's profile must show, by ``kind``:

* ``model``, ``category``: the receiver's label model or category is ``name``;
* ``contract``: its displayed contract name is ``name``;
* ``name``: its receiver name is ``name``;
* ``contract_like``: it is a smart contract and its lower-cased receiver name
  matches the LIKE pattern ``name``;
* ``staker``: it is a smart contract on the list of stakers (``name`` unused).

The rules are data: a new protocol is a new row, placed between others by its
place. ``default_rules`` holds the fixed ones, ten places apart.

How it runs: the four kinds of equality are joins of the profiles with the
rules of that kind, reduced to one row per name; broadcast after a size check
and otherwise shuffle joins that split hot names. Patterns and the staker rule
become one expression; their number is checked (``MOST_PATTERNS``).

Edge cases: NULL facts meet no rule, rules with a NULL place, kind, name (but
for ``staker``) or vertical are ignored, an unknown kind is an error. Of rules
with equal place the vertical that sorts first wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainfold.operators import rules as R
from chainfold.operators.joins import DEFAULT_BROADCAST_ROWS, has_at_most, materialize, membership_flag, split_hot_join
from chainfold.sources.tables import literal_table

RULES = T.StructType(
    [
        T.StructField("place", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("vertical", T.StringType()),
    ]
)
#: Profile column that each kind of equality rule reads.
EQUAL = {"model": "label_models", "category": "label_categories", "contract": "receiver_contract_name", "name": "receiver_name"}
MOST_PATTERNS = 1000


def default_rules(spark: SparkSession) -> DataFrame:
    """The fixed rules as a table."""
    names = {v: [("name", n, v) for n in listed] for v, listed in R.VERTICAL_NAMES}
    order = [
        ("model", R.BURN_MODEL, R.BURN_VERTICAL),
        ("contract", R.WRAPPER_CONTRACT, R.WRAPPER_VERTICAL),
        ("model", R.CEX_MODEL, R.CEX_VERTICAL),
        ("category", R.BRIDGE_CATEGORY, "bridge"),
        *names.pop("bridge"),
        ("category", R.DEX_CATEGORY, "DEX"),
        *names.pop("DEX"),
        ("contract_like", R.SWAP_PATTERN, "DEX"),
        *(rule for v in ("lending", "liquid staking", "restaking", "liquid restaking") for rule in names.pop(v)),
        ("staker", "", R.STAKING_VERTICAL),
        *(rule for listed in names.values() for rule in listed),
    ]
    return literal_table(spark, [(10 * (i + 1), *rule) for i, rule in enumerate(order)], RULES)


def _by_expression(rules: DataFrame) -> tuple[list[tuple[int, str, str]], list[tuple[int, str]]]:
    """(patterns, staker rules) in order of place."""
    rows = rules.where(F.col("kind").isin("contract_like", "staker")).limit(MOST_PATTERNS + 1).collect()
    if len(rows) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} rules with a pattern")
    rows.sort(key=lambda r: (r["place"], r["vertical"]))
    like = [(r["place"], r["name"], r["vertical"]) for r in rows if r["kind"] == "contract_like"]
    return like, [(r["place"], r["vertical"]) for r in rows if r["kind"] == "staker"][:1]


def _hit(place: int | Column, vertical: str | Column) -> Column:
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(as_column(place).alias("place"), as_column(vertical).alias("vertical"))


def classify_vertical(
    profiles: DataFrame,
    stakers: DataFrame | None,
    name_rules: DataFrame,
    *,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """``profiles`` (one row per receiver) with ``vertical`` added.

    Reads label_models, label_categories, receiver_contract_name,
    receiver_name, receiver_type, and ``is_staker``, which is computed from
    ``address`` and ``stakers.address`` if ``stakers`` is given.
    """
    valid = name_rules.select(*[F.col(f.name).cast(f.dataType) for f in RULES.fields]).dropna(subset=["place", "kind", "vertical"])
    unknown = valid.where(~F.col("kind").isin(*EQUAL, "contract_like", "staker")).select("kind").limit(1).collect()
    if unknown:
        raise ValueError(f"unknown kind of rule: {unknown[0]['kind']!r}")
    like, staking = _by_expression(valid.where(F.col("name").isNotNull() | (F.col("kind") == "staker")))
    out = profiles
    if stakers is not None:
        out = membership_flag(out.drop("is_staker"), "address", stakers, "address", "is_staker")
    equal = valid.where(F.col("kind").isin(*EQUAL)).dropna(subset=["name"])
    best = equal.groupBy("kind", "name").agg(F.min(_hit(F.col("place"), F.col("vertical"))).alias("hit"))
    small = has_at_most(equal, max_broadcast_rows)
    for kind, column in EQUAL.items():
        of_kind = best.where(F.col("kind") == kind).select(F.col("name").alias(column), F.col("hit").alias(f"__{kind}"))
        # the shuffle join reads its big side several times
        out = out.join(F.broadcast(of_kind), column, "left") if small else split_hot_join(materialize(out), of_kind, [column], "left")
    contract = F.col("receiver_type") == F.lit(R.SMART_CONTRACT)
    none = F.lit(None).cast("struct<place:int,vertical:string>")
    pattern = none
    for place, text, vertical in reversed(like):
        pattern = F.when(contract & F.lower("receiver_name").like(text), _hit(place, vertical)).otherwise(pattern)
    staked = none
    for place, vertical in staking:
        staked = F.when(contract & F.coalesce("is_staker", F.lit(False)), _hit(place, vertical))
    hits = [*(F.col(f"__{kind}") for kind in EQUAL), pattern, staked]
    found = F.array_min(F.filter(F.array(*hits), lambda h: h.isNotNull())).getField("vertical")
    return out.withColumn("vertical", F.coalesce(found, R.unclassified(F.col("receiver_type")))).drop(*(f"__{k}" for k in EQUAL))
