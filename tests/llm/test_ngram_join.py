from __future__ import annotations

import random
import re

import pytest

from chainfold.llm.components import component_labels
from chainfold.llm.ngram_join import drop_near_duplicates, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, shingle, num, den):
    """{row: (n_shingles, component)} by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)} if len(w) >= shingle else ({tuple(w)} if w else set()))
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None:
                both = len(sets[i] & sets[j])
                if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                    group[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(((doc, len(sets[i]), least.get(root(i))) for i, (doc, _) in enumerate(rows)), key=repr)


def corpus(seed, size=120):
    rnd = random.Random(seed)
    vocab = ["w%d" % i for i in range(60)]
    hot = " ".join(rnd.choice(vocab) for _ in range(80))
    rows, texts = [], []
    for i in range(size):
        kind = rnd.random()
        if texts and kind < 0.55:
            w = rnd.choice(texts).split(" ")
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab).upper()
            text = " ".join(w)
        elif kind < 0.7:
            text = hot + " " + " ".join(rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 3, 60])))
        else:
            text = " ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 2, 3, 5, 20, 90, 200])))
        texts.append(text)
        rows.append((rnd.randrange(10_000), text))
    return rows + [(None, hot), (1, None), (2, ""), (3, " \t\n"), (rows[0][0], "other text of the same id"), rows[1], rows[1]]


@pytest.mark.parametrize(("seed", "shingle", "num"), [(1, 3, 90), (2, 5, 80), (3, 1, 80)])
def test_matches_all_pairs(spark, seed, shingle, num):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs, shingle=shingle, num=num)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, shingle, num, 100)


@pytest.mark.parametrize(("num", "shingle", "n_words"), [(90, 3, 62), (80, 5, 70), (80, 1, 30)])
def test_near_copies_around_a_pivot(spark, monkeypatch, num, shingle, n_words):
    """Copies that differ from one text in a few places: linked, just apart, and linked with each other only."""
    from chainfold.llm import ngram_join as N

    monkeypatch.setattr(N, "LEAST_AROUND", 0)
    rnd = random.Random(num + shingle)
    base = [f"b{i}" for i in range(n_words)]
    rows = [(0, " ".join(base))]
    for i in range(1, 170):
        w = list(base)
        for _ in range(rnd.choice([1, 2, 2, 3, 4, 6])):
            at = rnd.randrange(n_words)
            w[at : at + rnd.choice([1, 1, 1, 0, 2])] = [rnd.choice(["x", f"u{i}", "y"])] * rnd.choice([1, 1, 0, 2])
        rows.append((i, " ".join(w)))
    rnd.shuffle(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=shingle, num=num)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, shingle, num, 100)


@pytest.mark.parametrize(("num", "shingle", "n_changes"), [(90, 3, 5), (80, 5, 7)])
def test_near_copies_below_the_threshold_hardly_meet(spark, monkeypatch, num, shingle, n_changes):
    """Copies that share some of their changes: most pairs are just below the threshold."""
    from chainfold.llm import ngram_join as N

    written, real = [], N.write_intermediate

    def write(df, name):
        out = real(df, name)
        if name in ("ngram-near", "ngram-around"):
            written.append((name, out.count()))
        return out

    monkeypatch.setattr(N, "write_intermediate", write)
    rnd = random.Random(num)
    base = [f"b{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 240):
        w = list(base)
        for at in rnd.sample(range(4, 146, 6), n_changes):
            w[at] = f"c{at}"
        rows.append((i, " ".join(w)))
    expected = brute(rows, shingle, num, 100)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=shingle, num=num)
    assert sorted(map(tuple, got.collect()), key=repr) == expected
    assert max(n for name, n in written if name == "ngram-around") >= 100
    assert max(n for name, n in written if name == "ngram-near") <= 5 * len(rows)


def test_signatures_are_shuffled_once_by_token(spark, monkeypatch):
    from chainfold.llm import ngram_join as N

    plans, real = [], N.write_intermediate

    def write(df, name):
        if name == "ngram-sized":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(N, "write_intermediate", write)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near_duplicates(spark.createDataFrame(corpus(5, 20), "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [plan.count("hashpartitioning(token") for plan in plans] == [1]


def test_hot_tokens_use_pairs_and_lose_nothing(spark, monkeypatch):
    """With every token in the frequent class the signatures are pairs of neighbours only."""
    import numpy as np

    from chainfold.llm import ngram_join as N

    monkeypatch.setattr(N, "_counts", lambda *a: np.zeros(N.COUNTERS, np.int64))
    real = N.signatures
    monkeypatch.setattr(N, "signatures", lambda t, c, f, n, d: real(t, c, 0, n, d))
    rnd = random.Random(9)
    rows = corpus(4, 80)
    tokens = [(np.unique(np.array([rnd.getrandbits(64) for _ in range(rnd.randint(2, 300))], np.uint64))) for _ in range(50)]
    for t in tokens:
        assert len(N.signatures(t, np.zeros(len(t), np.int64), 0, 90, 100)[1]) <= 0.35 * len(t) + 3
    assert sorted(map(tuple, near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, num=90).collect()), key=repr) == brute(rows, 3, 90, 100)


def test_empty_table_extra_columns_and_drop(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(none).collect() == []
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(5, text, "a"), (2, text.upper(), "b"), (9, text + " more", "c"), (7, "quite another text of more than five words", "d"), (None, text, "e"), (8, None, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["component_id"] for r in kept.collect()) == ["b", "d", "e", "f"]


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (200, 200)]
    got = {r["node"]: r["label"] for r in component_labels(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
