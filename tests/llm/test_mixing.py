from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from chainfold.llm import mixing as M


def corpus(spark, seed=3):
    rnd = random.Random(seed)
    words = {"a": ["apple", "pear", "fig", "plum"], "b": ["iron", "lead", "zinc", "tin"]}
    rows, labels = [], []
    for i in range(200):
        d = "a" if i % 4 else "b"
        rows.append((i, " ".join(rnd.choice(words[d]) for _ in range(rnd.randint(5, 60)))))
        if i % 2 or i % 8 == 0:
            labels.append((i, d))
    rows += [(500, None), (501, ""), (None, "apple pear"), rows[4], rows[4]]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels + [(3, None), (9, "other")], "doc_id long, domain string")


@pytest.mark.parametrize("targets", [{"a": 0.5, "b": 0.5}, {"a": 9, "b": 1}, {"a": 1.0, "b": 0.0}])
def test_targets_are_met_and_rates_solve_the_least_squares(spark, targets):
    docs, labels = corpus(spark)
    mix = M.fit_rates(docs, labels, targets)
    share = {d: w / sum(targets.values()) for d, w in targets.items()}
    rows = mix.units.collect()
    total = sum(r["n_tokens"] for r in rows)
    assert total == sum(len((r["text"] or "").split()) for r in docs.collect())
    assert all(r["rate"] >= 0 and abs(sum(r["posteriors"].values()) - 1) < 1e-9 for r in rows)
    for d in targets:
        got = sum(r["rate"] * r["n_tokens"] * r["posteriors"][d] for r in rows)
        assert got / total == pytest.approx(share[d], abs=2e-3)
        assert mix.reached[d] == pytest.approx(share[d], abs=4e-3)


def test_posteriors_follow_the_words(spark):
    docs, labels = corpus(spark)
    mix = M.fit_rates(docs, labels, {"a": 1, "b": 1})
    for r in mix.units.where("n_tokens > 0 and id is not null").collect():
        assert (r["posteriors"]["b"] > 0.5) == (r["id"] % 4 == 0)
    empty = mix.units.where("id = 500").first()
    assert empty["n_tokens"] == 0 and 0 < empty["posteriors"]["b"] < 0.5


def test_copies_follow_rates(spark):
    docs, labels = corpus(spark)
    mix = M.fit_rates(docs, labels, {"a": 1, "b": 1})
    wide = docs.withColumn("__id", F.lit("clash")).withColumn("rate", F.lit(1))
    taken = M.take_copies(wide, mix)
    assert taken.columns == wide.columns
    drawn = {(r["id"], r["text_hash"]): r["n"] for r in mix.units.select("id", "text_hash", M.copies(F.col("rate"), F.col("id"), F.col("text_hash")).alias("n")).collect()}
    rates = {(r["id"], r["text_hash"]): r["rate"] for r in mix.units.collect()}
    assert all(int(rates[k]) <= n <= int(rates[k]) + 1 for k, n in drawn.items())
    rows = docs.select("doc_id", F.xxhash64("text").alias("h")).collect()
    assert taken.count() == sum(drawn[(r["doc_id"], r["h"])] for r in rows)


def test_no_labels_empty_table_and_bad_targets(spark):
    docs, labels = corpus(spark)
    mix = M.fit_rates(docs, labels.limit(0), {"a": 1, "b": 1})
    assert all(r["rate"] == pytest.approx(1) for r in mix.units.collect())
    none = M.fit_rates(docs.limit(0), labels, {"a": 1, "b": 1})
    assert none.units.collect() == [] and none.reached == {"a": 0.0, "b": 0.0}
    assert M.take_copies(docs.limit(0), none).collect() == []
    with pytest.raises(ValueError, match="nonnegative"):
        M.fit_rates(docs, labels, {"a": 1, "b": -1})


def test_native_plan(spark):
    docs, labels = corpus(spark)
    mix = M.fit_rates(docs, labels, {"a": 1, "b": 1})
    assert "Python" not in M.take_copies(docs, mix)._jdf.queryExecution().toString()


def test_plans_hold_no_values_of_the_model(spark):
    docs, labels = corpus(spark)
    own, known = docs.withColumnRenamed("doc_id", "id"), labels.withColumnRenamed("doc_id", "id")
    plan = M.posteriors(own, known, ["a", "b"])._jdf.queryExecution()
    assert len(plan.toString()) < M.WORD_BUCKETS
    # no row carries the arrays: they stand inside the sums
    assert "AS slots1" not in plan.executedPlan().toString()


def test_one_domain(spark):
    docs, labels = corpus(spark)
    mix = M.fit_rates(docs, labels, {"a": 1})
    assert all(r["rate"] == pytest.approx(1) and r["posteriors"] == {"a": 1.0} for r in mix.units.collect())
    assert mix.reached == {"a": 1.0}
