from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from chainfold.llm import blocks as B
from chainfold.llm import toxicity as X


def corpus(n, seed=1, bad=("grumblefest", "snarklewort", "blotheration")):
    rnd = random.Random(seed)
    syllables = ["an", "er", "on", "th", "re", "ing", "ed", "ti", "es", "or"]
    rows = []
    for i in range(n):
        words = ["".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(10, 120))]
        toxic = int(rnd.random() < 0.25)
        if toxic:
            for _ in range(max(1, len(words) // 30)):
                words[rnd.randrange(len(words))] = rnd.choice(bad)
        rows.append((i, " ".join(words), toxic))
    return rows


def scores(model, texts):
    return X.score_block(model, *B.text_arrays(pa.array(texts)))


def test_learns_and_shares_misspellings():
    train, test = corpus(900), corpus(400, seed=2)
    model = X.train(pa.array([t for _, t, _ in train]), np.array([y for *_, y in train]), 0.25)
    got, y = scores(model, [t for _, t, _ in test]), np.array([y for *_, y in test])
    ranks = np.argsort(np.argsort(got))
    auc = (ranks[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())
    assert auc > 0.97
    assert ((got >= X.THRESHOLD) == y).mean() > 0.93
    clean = "an er on th re ing ed ti es or aner onth reing edti esor " * 2
    odd = scores(model, [clean + "grumblefezt", clean + "snarklewart", clean + "thereingti"])
    assert odd[0] > odd[2] and odd[1] > odd[2]


def test_scores_are_the_same_in_any_block_and_match_a_plain_version(spark):
    train = corpus(300)
    model = X.train(pa.array([t for _, t, _ in train]), np.array([y for *_, y in train]), 0.25)
    texts = [t for _, t, _ in corpus(40, seed=4)] + ["", None, "É idiot\n\nx"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, score string").repartition(3)
    got = {r["doc_id"]: r["score"] for r in X.score(docs, model).collect()}
    for i, t in enumerate(texts):
        words = (t or "").lower().split()
        owner, bucket = X.word_buckets([w.encode() for w in words])
        z = model.bias + np.mean([model.weight[bucket[owner == k]].mean() for k in range(len(words))]) if words else X._logit(model.prior)
        if "É" not in (t or ""):
            assert abs(got[i] - 1 / (1 + np.exp(-z))) < 1e-9


def test_labels_of_held_out_rows_are_not_used(spark):
    rows = corpus(400)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    learn = F.col("doc_id") % 4 != 2
    one = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    two = spark.createDataFrame([(i, 1 - y if i % 4 == 2 else y) for i, _, y in rows] + [(0, None), (None, 1)], "doc_id long, toxic int")
    a, b = X.fit(docs, one, learn), X.fit(docs, two, learn)
    assert np.array_equal(a.weight, b.weight) and a.bias == b.bias


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = X.fit(docs, labels, F.lit(True))
    assert all(r["score"] < 1e-5 for r in X.score(docs, model).collect())
    assert X.score(docs.limit(0), model).collect() == []


def test_repeated_ids_give_one_model_in_any_order(spark):
    rnd = random.Random(8)
    rows = [(i % 60, " ".join(rnd.choice(["good", "fine", "awful", "nasty"]) for _ in range(12))) for i in range(180)]
    labels = [(i, int(i % 3 == 0)) for i in range(60)] + [(i, 1) for i in range(0, 60, 7)]
    models = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        random.Random(seed).shuffle(labels)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(seed + 1)
        models.append(X.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True)))
    assert np.array_equal(models[0].weight, models[1].weight) and models[0].bias == models[1].bias
