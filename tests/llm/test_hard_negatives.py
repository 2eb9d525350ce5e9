from __future__ import annotations

import itertools
import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chainfold.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=10, low=30, high=90):
    kept = {}
    for i, v, label in rows:
        if None in (i, label) or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        kept[(i, label, q)] = None
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, label, q in kept:
        if i % 100:
            continue
        scored = sorted((-score(q, w), j, k) for j, k, w in kept if j != i)
        for s, j, _ in [x for x in scored if x[2] == label][:positives]:
            p = -s
            fits = [(j2, -s2) for s2, j2, k in sorted((-score(q, w), j2, k) for j2, k, w in kept) if k != label and low * p <= -100 * s2 <= high * p]
            out += [(i, j, r + 1, n, p, t) for r, (n, t) in enumerate(fits[:negatives])]
    return sorted(out)


def table(seed, n, dims, clustered):
    rnd = random.Random(seed)
    centres = [[rnd.uniform(-0.5, 0.5) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rnd.choice(centres) if clustered else [0.0] * dims
        rows.append((i * 5, [x + rnd.gauss(0, 0.1) for x in c], rnd.randrange(3)))
    same = rows[3][1]
    rows += [(5000 + i, same, i % 2) for i in range(40)]
    rows += [rows[0], rows[20], (100, rows[7][1], 1), (None, same, 1), (6000, None, 1), (6100, [None] * dims, 1)]
    rows += [(6200, [float("nan")] * dims, 0), (6300, [float("inf")] * dims, 0), (6400, same, None), (6500, same[:1], 2), (6600, [], 0)]
    return rows


@pytest.mark.parametrize(("seed", "dims", "clustered"), [(1, 3, True), (2, 8, False)])
def test_matches_brute_force(spark, monkeypatch, seed, dims, clustered):
    rows = table(seed, 400, dims, clustered)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert sorted(map(tuple, H.mine(df, F.col("vec_id") % 100 == 0).collect())) == brute(rows)


def test_small_pages_and_large_components(spark):
    rows = [(i, [random.Random(i).uniform(-4e5, 4e5), 1e5], i % 2) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(1)).withColumn("id", F.lit("x"))
    got = H.mine(df, F.col("vec_id") % 100 == 0, positives=2, negatives=3, low=10, high=70).collect()
    assert sorted(map(tuple, got)) == brute(rows, 2, 3, 10, 70)
    with pytest.raises(ValueError, match="56 bits"):
        H.mine(spark.createDataFrame([(0, [1e30], 1)], SCHEMA), F.lit(True))


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert H.mine(empty, F.lit(True)).collect() == []
    assert H.mine(spark.createDataFrame([(1, [0.5], 1), (2, None, 1)], SCHEMA), F.lit(True)).collect() == []


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_moves_one_cell_at_a_time(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = [k.tobytes() for k in H.hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    walk = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_score_and_choose_blocks():
    rng = np.random.default_rng(0)
    block = rng.integers(-50, 50, (64, 5)).astype(float)
    q = rng.integers(-50, 50, (20, 5)).astype(float)
    least, most = H.bounds(q, block.min(0)[None], block.max(0)[None])
    scores = q @ block.T
    assert (least[:, 0] <= scores.min(1)).all() and (scores.max(1) <= most[:, 0]).all()


def test_few_pages_are_read_where_vectors_cluster(spark):
    """Bounds part clusters: anchors are sent to a part of the pages only."""
    rng = np.random.default_rng(1)
    rows = [(i, (np.eye(4)[i % 4] + rng.normal(0, 0.01, 4)).tolist(), i % 4) for i in range(2000)]
    space = H._Space(4, -400, 400)
    placed = H._placed(H._prepare(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", "label", F.col("vec_id") % 100 == 0, 256), space)
    pages = H._paged(placed.repartition(4), space).cache()
    zones = H._packed_zones(pages)
    seeds = H._first_scores(pages, space, 5).withColumn("lows", F.array("low")).withColumn("highs", F.array(F.lit(H._MOST)))
    chosen = H._chosen(H._packed_anchors(seeds, space), zones, space, True).collect()
    sent = sum(np.unpackbits(np.frombuffer(r["blocks"], np.uint8)).sum() for r in chosen)
    blocks = sum(len(r["label_lo"]) // 8 for r in pages.collect())
    assert 0 < sent < 0.5 * 20 * blocks
    pages.unpersist()


class _Table:
    """Stands for a frame; hands back the function that would run over its rows."""

    def __getattr__(self, name):
        return lambda *args: args[0] if name == "mapInArrow" else 2 if name == "count" else self


def _packed(space, rng, n, **windows):
    anchors = {"ids": np.arange(n) * 100, "keys": np.arange(n), "labels": rng.integers(0, 4, n), "vectors": rng.integers(-100, 100, (n, space.dims)).astype(space.store)}
    return anchors | {k: np.tile(np.array(v, np.int64), (n, 1)) for k, v in windows.items()}


def _peak(fn, rows):
    """(batches, most bytes held beyond the input) of a run over batches of one row."""
    batches = [pa.RecordBatch.from_pylist([{k: v.tobytes() if isinstance(v, np.ndarray) else v for k, v in row.items()}]) for row in rows]
    tracemalloc.start()
    out = list(fn(iter(batches)))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, most


def test_memory_of_a_page_does_not_grow_with_anchors_times_rows(spark):
    """All scores of 4,000 anchors and a full page would take over half a gigabyte."""
    rng = np.random.default_rng(3)
    space = H._Space(64, -100, 100)
    n, rows = 4000, 16 * 1024
    page = {"page_ids": np.arange(rows), "page_labels": rng.integers(0, 4, rows), "page_vectors": rng.integers(-100, 100, (rows, 64)).astype(space.store)}
    q = _packed(space, rng, n, lows=[20_000, 15_000, 1], highs=[60_000, 55_000, 0])
    blocks = np.packbits(rng.random((n, rows // H.BLOCK_ROWS)) < 0.9, axis=1)
    for same in (True, False):
        out, most = _peak(H._best(_Table(), _Table(), space, same, 3), [page | q | {"blocks": blocks}])
        assert most < 100 << 20
        got = {}
        for r in pa.Table.from_batches(out).to_pylist():
            got.setdefault((r["anchor"], r["window"]), []).append((-r["score"], r["id"]))
        mask = np.repeat(np.unpackbits(blocks, axis=1), H.BLOCK_ROWS, axis=1).astype(bool)
        for i in range(0, n, 400):
            fits = mask[i] & ((page["page_labels"] == q["labels"][i]) == same) & ~(same & (page["page_ids"] == q["ids"][i]))
            scores = page["page_vectors"].astype(np.int64) @ q["vectors"][i].astype(np.int64)
            for w, (low, high) in enumerate(zip(q["lows"][i], q["highs"][i], strict=True)):
                some = np.flatnonzero(fits & (scores >= low) & (scores <= high))
                assert got.get((q["ids"][i], w), []) == sorted((-int(scores[r]), int(r)) for r in some)[:3]


def test_memory_of_the_bounds_does_not_grow_with_anchors_times_blocks(spark):
    """All bounds of 4,000 anchors and 8,000 blocks would take over half a gigabyte."""
    rng = np.random.default_rng(4)
    space = H._Space(64, -100, 100)
    n, blocks, of = 4000, 8000, 500
    zones = {"pages": np.arange(blocks) // of, "label_lo": np.zeros(blocks, np.int64), "label_hi": np.full(blocks, 3)}
    zones |= {"lo": rng.integers(-100, 0, (blocks, 64)).astype(space.store), "hi": rng.integers(0, 100, (blocks, 64)).astype(space.store)}
    q = _packed(space, rng, n, lows=[150_000], highs=[H._MOST])
    out, most = _peak(H._chosen(_Table(), _Table(), space, True), [zones | q])
    assert most < 150 << 20
    chosen = pa.Table.from_batches(out).to_pylist()
    assert [r["page"] for r in chosen] == list(range(blocks // of))
    i, page = 1234, 7
    own = slice(page * of, page * of + of)
    x, lo, hi = q["vectors"][i].astype(np.int64), zones["lo"][own].astype(np.int64), zones["hi"][own].astype(np.int64)
    want = np.maximum(x * lo, x * hi).sum(1) >= 150_000
    at = np.flatnonzero(np.frombuffer(chosen[page]["keys"], np.int64) == i)
    mask = np.unpackbits(np.frombuffer(chosen[page]["blocks"], np.uint8).reshape(-1, -(-of // 8)), axis=1, count=of)
    assert mask[at].astype(bool).tolist() == ([want.tolist()] if want.any() else [])


@pytest.mark.parametrize(("low", "high"), [(-100, 100), (-2000, 2000), (-(1 << 24), 1 << 24)])
def test_ties_and_types_of_scores(low, high):
    """Rows that tie at the last place of a page's share are all weighed by id, whatever type scores have."""
    rng = np.random.default_rng(5)
    space = H._Space(64, low, high)
    vectors = np.repeat(rng.integers(low, high, (40, 64)), 20, axis=0).astype(space.store)
    ids, labels = rng.permutation(800), rng.integers(0, 2, 800)
    top = int((vectors[0].astype(np.int64) @ vectors[0].astype(np.int64)))
    asked = H._Asked({k: v.tobytes() for k, v in {"ids": ids[:1], "keys": ids[:1], "labels": labels[:1], "vectors": vectors[:1], "lows": np.array([-top, top // 9]), "highs": np.array([top, top // 2])}.items()}, space)
    scores = (vectors.astype(np.int64) @ vectors[0].astype(np.int64)).tolist()
    found = H._of_page(asked, slice(0, 1), np.ones((1, 13), bool), asked.vectors @ vectors.astype(space.work).T, ids, labels, space.none, False, 5)
    for w, (a, b) in enumerate(((-top, top), (top // 9, top // 2))):
        want = sorted((-s, int(i)) for s, i, k in zip(scores, ids, labels, strict=True) if k != labels[0] and a <= s <= b)[:5]
        assert [(-int(s), int(i)) for f in found if f[1] == w for s, i in zip(f[3], f[2], strict=True)] == want
