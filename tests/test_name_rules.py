"""Verticals by a table of rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from chainfold.operators import labels as L
from chainfold.operators.name_rules import RULES, classify_vertical, default_rules
from chainfold.plans.testdata import label_inputs
from tests.conftest import SMOKE_DIR

PROFILE = "address string, label_models string, label_categories string, receiver_contract_name string, receiver_name string, receiver_type string"


def verticals(spark, rows, rules, stakers=(), **kw):
    profiles = spark.createDataFrame(rows, PROFILE)
    staked = spark.createDataFrame([(s,) for s in stakers], "address string")
    return {r["address"]: r["vertical"] for r in classify_vertical(profiles, staked, rules, **kw).collect()}


PROFILES = [
    ("a", "burn_addresses", "bridge", None, "Aave", "EOA"),
    ("b", None, "dex", "Myname: WETH9", "Lido", "Smart contract"),
    ("c", None, None, None, "MegaSwapper", "Smart contract"),
    ("d", None, None, None, "MegaSwapper", "EOA"),
    ("e", None, None, None, "Stakefish", "Smart contract"),
    ("f", None, None, None, "Lido", "EOA"),
    ("g", None, None, None, None, "Burner address"),
    ("h", None, "dex", None, "Stargate", "Smart contract"),
]


@pytest.mark.parametrize("kw", [{}, {"max_broadcast_rows": 0}])
def test_default_rules(spark, kw):
    assert verticals(spark, PROFILES, default_rules(spark), ["e", "f"], **kw) == {
        "a": "burn address",
        "b": "eth wrapping",
        "c": "DEX",
        "d": "unclassified transfer to EOA",
        "e": "ETH staking",
        "f": "liquid staking",
        "g": "unclassified transfer to Burner address",
        "h": "bridge",
    }


@pytest.mark.parametrize("kw", [{}, {"max_broadcast_rows": 0}])
def test_a_rule_of_the_user_needs_no_code(spark, kw):
    own = spark.createDataFrame(
        [
            (1, "name", "Lido", "mine"),
            (2, "name", "Lido", "later"),
            (5, "category", "dex", "b, equal place"),
            (5, "name", "Stargate", "a, equal place"),
            (9, "contract_like", "%fish", "fish"),
            (None, "name", "Stargate", "no place"),
            (0, "name", None, "no name"),
            (0, "name", "Stargate", None),
        ],
        RULES,
    )
    alone = verticals(spark, PROFILES, own, ["e"], **kw)
    assert (alone["b"], alone["f"], alone["h"], alone["e"]) == ("mine", "mine", "a, equal place", "fish")
    assert alone["a"] == "unclassified transfer to EOA"
    both = verticals(spark, PROFILES, default_rules(spark).unionByName(own), ["e"], **kw)
    assert (both["a"], both["f"], both["e"]) == ("burn address", "mine", "fish")
    with pytest.raises(ValueError, match="unknown kind"):
        verticals(spark, PROFILES, spark.createDataFrame([(1, "nam", "x", "y")], RULES))
    none = verticals(spark, PROFILES, own.limit(0), **kw)
    assert none["f"] == "unclassified transfer to EOA"


def test_rules_reach_the_label_step(spark):
    inputs = label_inputs(spark, SMOKE_DIR)
    before = {r["vertical"] for r in L.label_transfers(inputs).select("vertical").distinct().collect()}
    own = spark.createDataFrame([(1, "name", "Pendle", "fixed yield")], RULES)
    after = L.label_transfers(inputs | {"name_rules": default_rules(spark).unionByName(own)})
    found = {r["vertical"] for r in after.select("vertical").distinct().collect()}
    assert "yield" in before and found == before - {"yield"} | {"fixed yield"}
    assert after.where("vertical = 'fixed yield'").where(F.col("receiver_name") != "Pendle").isEmpty()
