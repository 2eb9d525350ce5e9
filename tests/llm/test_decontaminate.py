from __future__ import annotations

import random
import re

import numpy as np
import pytest

from chainfold.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window):
    grams = []
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        grams += [(item, tuple(w[p : p + n])) for p in range(len(w) - n + 1) if n]
    out = []
    for doc, text in docs:
        w = words(text)
        hit, met, longest = [False] * len(w), set(), 0
        for item, g in grams:
            for p in range(len(w) - len(g) + 1):
                if tuple(w[p : p + len(g)]) == g:
                    hit[p : p + len(g)] = [True] * len(g)
                    if item is not None:
                        met.add(str(item))
        if any(hit):
            for _, t in items:
                v = words(t)
                for i in range(len(v)):
                    for p in range(len(w)):
                        n = 0
                        while i + n < len(v) and p + n < len(w) and v[i + n] == w[p + n]:
                            n += 1
                        longest = max(longest, n if n >= min(window, len(v)) else 0)
        spans = re.finditer("1+", "".join("1" if h else "0" for h in hit))
        out.append((doc, len(w), sum(hit), sorted(met), [m.span() for m in spans], longest))
    return sorted(out, key=repr)


def found(df):
    return sorted(
        (
            (r["doc_id"], r["n_words"], r["n_hit"], r["items"], [tuple(s) for s in r["spans"]], r["longest"]["n_words"] if r["longest"] else 0)
            for r in df.collect()
        ),
        key=repr,
    )


def tables(seed):
    rnd = random.Random(seed)
    vocab = ["aé", "b2", "c", "日本", "e"]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([3, 6, 9, 10, 11, 25])))) for i in range(12)]
    items += [(3, "b2 c " * 6), (None, "c c c c aé aé"), (20, None), (21, "  ,;"), (22, "Zz")]
    docs = []
    for _ in range(60):
        w = []
        for _ in range(rnd.randint(0, 5)):
            _, text = rnd.choice(items[:12])
            w.append(text.upper() if rnd.random() < 0.3 else text)
            w += [rnd.choice([*vocab, "zzz", "Zz" if rnd.random() < 0.1 else "q"]) for _ in range(rnd.randint(0, 4))]
        docs.append((rnd.randrange(1000), rnd.choice([" ", "-", "\n", " . "]).join(w)))
    return docs + [(None, items[0][1]), (5, None), (6, ""), (7, "!!"), docs[0], (8, "b2 c " * 300)], items


@pytest.mark.parametrize(("seed", "window", "shard", "block"), [(1, 10, 1 << 20, 8 << 20), (2, 4, 50, 8 << 20), (3, 10, 64, 120)])
def test_matches_brute_force(spark, monkeypatch, seed, window, shard, block):
    monkeypatch.setattr(D, "SHARD_WORDS", shard)
    monkeypatch.setattr(D, "TEST_BYTES", block)
    docs, items = tables(seed)
    if shard == 64:
        # what the tasks use: one block of text at a time, shards by hand
        monkeypatch.setattr(D.B, "BLOCK_BYTES", 200)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    tests = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    expected = brute(docs, items, window)
    assert found(D.find(frame, tests, window=window)) == expected
    kept = sorted((tuple(r) for r in D.remove(frame, tests, window=window).collect()), key=repr)
    clean = {e[0] for e in expected if e[2] == 0}
    assert {k[0] for k in kept} <= clean
    assert len(kept) == sum(e[2] == 0 for e in expected)


def test_shards_and_long_documents(monkeypatch):
    monkeypatch.setattr(D, "SHARD_WORDS", 40)
    monkeypatch.setattr(D.B, "BLOCK_BYTES", 64)
    docs, items = tables(5)
    tests = D.Tests.of([None if i is None else str(i) for i, t in items if t], [t for _, t in items if t], 10)
    got = []
    texts = D.pa.array([t for _, t in docs], D.pa.string())
    for i, j, hits in D._hits(texts, tests):
        for (doc, _), r in zip(docs[i:j], D.pa.table(hits.rows()).to_pylist(), strict=True):
            spans = [(s["start"], s["end"]) for s in r["spans"]]
            got.append((doc, r["n_words"], r["n_hit"], r["items"], spans, r["longest"]["n_words"] if r["longest"] else 0))
    assert sorted(got, key=repr) == brute(docs, items, 10)


def test_suffix_array_order():
    rnd = np.random.default_rng(0)
    for _ in range(30):
        s = rnd.integers(1, 4, 200).astype(np.int32)
        cuts = np.append(np.sort(rnd.choice(np.arange(1, 200), 8, replace=False)), 200)
        ends = cuts[np.searchsorted(cuts, np.arange(200), "right")]
        order = D.suffix_array(s, ends, 16)
        keys = [tuple(s[p : min(ends[p], p + 16)]) for p in order]
        assert keys == sorted(keys) and sorted(order) == list(range(200))


def test_empty_tables_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, "x"), (2, "d", 6, None)], "doc_id long, text string, n_hit long, `items.a` string")
    tests = spark.createDataFrame([(1, "A-B", "y")], "item_id long, text string, doc_id string")
    assert D.remove(docs, tests).collect() == docs.where("doc_id = 2").collect()
    assert found(D.find(docs, tests)) == [(1, 3, 2, ["1"], [(0, 2)], 2), (2, 1, 0, [], [], 0)]
    assert found(D.find(docs, tests.limit(0))) == [(1, 3, 0, [], [], 0), (2, 1, 0, [], [], 0)]
    assert D.find(docs.limit(0), tests).collect() == [] and D.remove(docs.limit(0), tests.limit(0)).collect() == []
