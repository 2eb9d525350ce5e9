from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from chainfold.llm import search as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, queries, k):
    own = [(i, Counter(WORD.findall((t or "").lower()))) for i, t in docs if i is not None]
    n, mean = len(own), sum(sum(c.values()) for _, c in own) / max(1, len(own))
    df = Counter(w for _, c in own for w in c)
    out = {}
    for q, text in queries:
        terms = set(WORD.findall((text or "").lower()))
        scored = {}
        for i, c in own:
            s = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for w in terms if w in c)
            if s:
                scored[i] = max(s, scored.get(i, 0))
        if q is not None and scored:
            out[q] = sorted(((-round(s, 9), i) for i, s in scored.items()))[:k]
    return out


def corpus(seed, size):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(size):
        words = [vocab[min(399, int(rnd.expovariate(0.02)))] for _ in range(rnd.choice([1, 5, 30, 120]))]
        rows.append((i * 10, " ".join(words)))
    rows += [(7, rows[3][1]), (8, rows[3][1].upper()), (9, None), (11, ""), (None, "w1 w2")]
    return rows


@pytest.mark.parametrize(("doc_block", "block_terms", "partitions"), [(64, 1_000_000, 3), (4, 50, 7)])
def test_matches_full_scoring(spark, monkeypatch, doc_block, block_terms, partitions):
    monkeypatch.setattr(S, "DOC_BLOCK", doc_block)
    monkeypatch.setattr(S, "BLOCK_TERMS", block_terms)
    monkeypatch.setattr(S, "FIRST_DOCS", 6)
    rows = corpus(1, 400)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    asked = [(i, t) for i, t in rows if i is not None and i % 100 == 0] + [(5, "w0 w1 W2"), (6, None), (1, "nothing")]
    queries = spark.createDataFrame(asked, "doc_id long, text string")
    got = {}
    for r in S.top_k(S.build_index(docs), queries, k=5).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (-round(r["score"], 9), r["doc_id"])
    assert {q: [v[k] for k in sorted(v)] for q, v in got.items()} == brute(rows, asked, 5)


def test_pruning_skips_blocks_and_is_exact():
    rng = np.random.default_rng(1)
    texts = [" ".join(f"t{int(x)}" for x in rng.zipf(1.4, 40) if x < 5000) for _ in range(3000)]
    import pyarrow as pa

    from chainfold.llm import blocks as B

    offsets, data = B.text_arrays(pa.array(texts))
    lengths, terms, at, docs, counts = S._shard(offsets, data)
    row = {"ids": np.arange(3000).tobytes(), "lengths": lengths.astype(np.int32).tobytes(), "terms": terms.tobytes(), "offsets": at.astype(np.int64).tobytes(), "docs": docs.tobytes(), "counts": counts.tobytes()}
    shard = S.Shard(row, lengths.mean())
    idf = np.log(1 + (3000 - np.diff(at) + 0.5) / (np.diff(at) + 0.5))
    for q in range(0, 3000, 150):
        own = np.flatnonzero(np.isin(terms, B.split_words(offsets[q : q + 2], data[offsets[q] : offsets[q + 1]], True).hashes))
        ids, scores = shard.top(terms[own], idf[own], 10)
        total = np.zeros(3000)
        for k in own:
            np.add.at(total, docs[at[k] : at[k + 1]], shard.weights[at[k] : at[k + 1]] * idf[k])
        best = np.lexsort((np.arange(3000), -total))[:10]
        assert ids.tolist() == best.tolist() and np.allclose(scores, total[best])
    assert 20 * 10 <= shard.scored < 0.5 * 20 * 3000


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "a")], "doc_id long, text string")
    assert S.top_k(S.build_index(none), some).collect() == []
    assert S.top_k(S.build_index(some), none).collect() == []
    assert sorted((r["query_id"], r["doc_id"], r["rank"]) for r in S.top_k(S.build_index(some), some).collect()) == [(1, 1, 1), (1, 2, 2), (2, 1, 2), (2, 2, 1)]


def test_copies_of_a_query_are_asked_once(spark, monkeypatch):
    asked = []
    search = S._search_block
    monkeypatch.setattr(S, "_search_block", lambda index, block, *rest: asked.append(block.count()) or search(index, block, *rest))
    docs = spark.createDataFrame([(i, f"w{i % 7} w{i % 5} x") for i in range(60)], "doc_id long, text string")
    rows = [(i, "x w1 w2") for i in range(40)] + [(100, "w3 x"), (100, "w3 x")]
    got = S.top_k(S.build_index(docs), spark.createDataFrame(rows, "doc_id long, text string"), k=3).collect()
    assert sum(asked) == 2 and len(got) == 41 * 3
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    assert len({tuple(sorted(by[i])) for i in range(40)}) == 1
    want = brute([(i, f"w{i % 7} w{i % 5} x") for i in range(60)], rows, 3)
    assert {q: [(-round(s, 9), d) for _, d, s in sorted(v)] for q, v in by.items()} == want


def _indexed(seed, n):
    import pyarrow as pa

    from chainfold.llm import blocks as B

    rng = np.random.default_rng(seed)
    offsets, data = B.text_arrays(pa.array([" ".join(f"t{int(x)}" for x in rng.zipf(1.3, rng.integers(1, 120)) if x < 3000) + " end" for _ in range(n)]))
    lengths, terms, at, docs, counts = S._shard(offsets, data)
    row = {"ids": np.arange(n), "lengths": lengths.astype(np.int32), "terms": terms, "offsets": at.astype(np.int64), "docs": docs, "counts": counts}
    idf = np.log(1 + (n - np.diff(at) + 0.5) / (np.diff(at) + 0.5))
    asked = [np.flatnonzero(np.isin(terms, B.split_words(offsets[q : q + 2], data[offsets[q] : offsets[q + 1]], True).hashes)) for q in range(0, n, 40)]
    return {c: v.tobytes() for c, v in row.items()}, lengths.mean(), idf, asked


@pytest.mark.parametrize("common_bytes", [48 << 20, 30_000, 1])
def test_batched_queries_with_floors_are_exact_and_score_few(monkeypatch, common_bytes):
    """Floors known from other shards leave nearly all documents unscored, whichever lists are held as common."""
    monkeypatch.setattr(S, "COMMON_BYTES", common_bytes)
    row, mean, idf, asked = _indexed(5, 2001)
    shard = S.Shard(row, mean)
    assert (len(shard.block_top) > 20) == (common_bytes > 30_000)
    shard.weigh(shard.terms, idf)
    queries = np.concatenate(asked), np.cumsum([len(own) for own in asked])
    full = []
    for own in asked:
        total = np.zeros(len(shard.ids))
        for t in own:
            a, b = shard.offsets[t], shard.offsets[t + 1]
            np.add.at(total, shard.docs[a:b], shard.weights[a:b] * idf[t])
        full.append(total)
    floors = [np.sort(total)[-3] for total in full]
    before = shard.scored
    for (ids, scores), total, floor in zip(shard.tops(*queries, floors, 5), full, floors, strict=True):
        best = np.lexsort((shard.ids, -total))[:5]
        best = best[total[best] >= floor]
        assert ids[: len(best)].tolist() == best.tolist() and scores[: len(best)].tolist() == total[best].tolist()
    by_floors = shard.scored - before
    assert [ids.tolist() for ids, _ in shard.tops(*queries, [0.0] * len(asked), 5)] == [np.lexsort((shard.ids, -total))[:5].tolist() for total in full]
    assert len(asked) <= by_floors < shard.scored - before - by_floors


def test_seed_shards_set_floors_for_the_others(spark, monkeypatch):
    """Half of the shards go first; the others return only what can still be among the best."""
    monkeypatch.setattr(S, "SEED_SHARE", 2)
    written = []
    write = S.write_intermediate
    monkeypatch.setattr(S, "write_intermediate", lambda df, name: written.append((name, out := write(df, name))) or out)
    rows = corpus(3, 600)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    index = S.build_index(docs)
    assert 0 < index.where("seed = 1").count() < index.count()
    asked = [(i, t) for i, t in rows if i is not None and i % 200 == 0] + [(3, "w399 w3 nothing")]
    got = {}
    for r in S.top_k(index, spark.createDataFrame(asked, "doc_id long, text string"), k=4).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (-round(r["score"], 9), r["doc_id"])
    assert {q: [v[k] for k in sorted(v)] for q, v in got.items()} == brute(rows, asked, 4)
    seeds, others = (out.count() for name, out in written if name == "search-found")
    assert others < index.where("seed = 0").count() * len(got) * 4 / 2 and seeds > 0


def test_shard_without_words(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, " \t "), (3, "b")], "doc_id long, text string").repartitionByRange(3, "doc_id")
    got = S.top_k(S.build_index(docs), docs, k=2).collect()
    assert sorted((r["query_id"], r["doc_id"], r["rank"]) for r in got) == [(1, 1, 1), (1, 3, 2), (3, 1, 2), (3, 3, 1)]


@pytest.mark.parametrize("most", [0, 1, 255, 256, 65_535, 65_536, 3_000_000])
def test_numbers_of_the_index_are_narrow(most):
    values = np.array([0, most, 1], np.int32)
    small = S._narrow(values)
    assert small.itemsize == (1 if most < 256 else 2 if most < 65_536 else 4)
    assert S._widen(small.tobytes(), 3).tolist() == S._widen(values.tobytes(), 3).tolist() == values.tolist()
    assert S._widen(b"", 0).tolist() == []
