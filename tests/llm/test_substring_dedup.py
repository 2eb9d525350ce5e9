from __future__ import annotations

import random
import re

import pytest

from chainfold.llm.substring_dedup import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    first = {}
    for (doc, _), w in zip(rows, words, strict=True):
        if doc is not None:
            for p in range(len(w) - window + 1):
                k = tuple(w[p : p + window])
                first[k] = min(first.get(k, doc), doc)
    out = []
    for (doc, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[p : p + window])] < doc:
                gone[p : p + window] = [True] * window
        out.append((doc, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def corpus(seed):
    rnd = random.Random(seed)
    vocab = ["é%d" % i for i in range(9)]
    passages = [[rnd.choice(vocab) for _ in range(rnd.choice([6, 13, 14, 60]))] for _ in range(8)]
    rows = []
    for _ in range(90):
        w = []
        for _ in range(rnd.randint(0, 6)):
            w += rnd.choice(passages) if rnd.random() < 0.6 else [rnd.choice(vocab) + str(rnd.random()) for _ in range(rnd.randint(1, 9))]
        rows.append((rnd.randrange(-50, 5000), rnd.choice([" ", "\n", "\t "]).join(w)))
    return rows + [(None, " ".join(passages[3])), (7, None), (8, ""), (9, " \n"), rows[0], (rows[1][0], rows[2][1])]


@pytest.mark.parametrize(("seed", "window"), [(1, 13), (2, 13), (3, 3), (4, 6)])
def test_matches_brute_force(spark, seed, window):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = remove_repeats(docs.repartition(5), window=window).select("doc_id", "n_words", "n_removed", "kept_text")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, window)


def test_empty_table_and_spans(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    a = " ".join(f"w{i}" for i in range(20))
    rows = [(1, a), (2, "x " + a + " y"), (3, a)]
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, kept_text string")
    got = {r["doc_id"]: r for r in remove_repeats(docs).collect()}
    assert got[1]["removed"] == [] and got[2]["removed"] == [[1, 21]] and got[3]["kept_text"] == ""
    assert got[2]["kept_text"] == "x y"
