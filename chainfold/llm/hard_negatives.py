"""Hard negatives from Hilbert-ordered Parquet blocks with zone maps.

All rows with a label and a whole, finite vector are candidates. Components
are scaled and floored to integers, so inner products are exact. The
candidates are sorted along a Hilbert curve over all dimensions and written
as Parquet pages; a page holds blocks of ``BLOCK_ROWS`` rows, and for each
block a zone map: the least and largest value of every dimension and of the
label.

For an anchor ``q`` and a block, interval arithmetic bounds every score:
each dimension adds between ``min(q * lo, q * hi)`` and ``max(q * lo, q * hi)``.

1. Positives: the anchor's own page gives a first ``positives``-th best score
   of its label. Blocks that can hold the label and whose upper bound reaches
   that score are read; all others can't hold a better row.
2. Negatives: each positive score ``p`` opens a window from ``low`` to
   ``high`` percent of ``p``. Blocks that can hold another label and whose
   bounds meet one of the anchor's windows are read.

How it runs: the zone maps (pruned read) meet the anchors in packed rows; a
page is read for an anchor only if one of its blocks is chosen, and each page
returns its best rows of each window. Bounds and scores are worked out for some
anchors at a time, about ``CELLS`` of them, so a task's memory does not grow
with anchors times rows. The anchors are a stated query set:
their work grows with anchors times candidates where bounds don't separate
blocks (unclustered vectors of many dimensions), and with what is chosen
where they do. Ranking prunes before its shuffle (row_number limits).

Edge cases: rows with a null id, label or vector, or a null or non-finite
component, take no part; exact repeats of id, label and vector are one row.
Rows that share an id but differ are rows of their own, but never each
other's positive. Shorter vectors are filled up with zeros. Ties go to the
smaller id. A window of a negative score is empty. An anchor without
positives or a window without rows gives no output; empty tables give none.
Vectors whose scores could exceed 56 bits are refused with an error. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainfold.storage import discard, write_intermediate

#: Rows of one zone map.
BLOCK_ROWS = 64
#: Bytes of the vectors of one page, and of packed anchors or zone maps.
PAGE_BYTES = 4 << 20
PACK_BYTES = 1 << 20
#: Scores or bounds held at once by a task.
CELLS = 1 << 20
#: Bits of each dimension on the curve.
CURVE_BITS = 4

_OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_PAGE = "page long, ids binary, labels binary, asking binary, vectors binary, lo binary, hi binary, label_lo binary, label_hi binary"
_ROW = "id long, label long, anchor boolean, key binary, vector binary"
_ANCHORS = "ids binary, keys binary, labels binary, vectors binary, lows binary, highs binary"
_LEAST, _MOST = -(1 << 63) + 1, (1 << 63) - 1


def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``grid`` (``bits``-bit numbers), as big-endian bytes.

    Axes to transposed index and back to one number, after Skilling (2004).
    """
    x = np.ascontiguousarray(grid.T).astype(np.uint32)
    dims = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        low = np.uint32(q - 1)
        for i in range(dims):
            swap = np.where(x[i] & np.uint32(q), 0, (x[0] ^ x[i]) & low).astype(np.uint32)
            x[0] ^= np.where(x[i] & np.uint32(q), low, swap).astype(np.uint32)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where(x[dims - 1] & np.uint32(q), q - 1, 0).astype(np.uint32)
    x ^= turn
    planes = [(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def bounds(vectors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) possible inner product of each vector with a row between ``lo`` and ``hi``."""
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    return up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T


def _rows(columns: dict[str, list], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) for k, t in types.items()], list(types))


class _Space:
    """Dimensions, storage type and the type scores are computed in."""

    def __init__(self, dims: int, low: int, high: int):
        most = max(abs(low), abs(high))
        if dims * most * most >= 1 << 56:
            raise ValueError(f"components up to {most} in {dims} dimensions: scores could exceed 56 bits")
        self.dims, self.low, self.high = max(dims, 1), low, high
        self.store = np.dtype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)
        self.work = np.dtype(np.float32 if dims * most * most < 1 << 24 else np.float64 if dims * most * most < 1 << 53 else np.int64)
        self.none = np.iinfo(np.int64).min if self.work == np.int64 else -np.inf
        self.page_rows = max(1, PAGE_BYTES // (self.dims * self.store.itemsize * BLOCK_ROWS)) * BLOCK_ROWS

    def read(self, data) -> np.ndarray:
        return np.frombuffer(data, self.store).reshape(-1, self.dims).astype(self.work)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        spread = self.high - self.low + 1
        cell = (vectors.astype(np.float64) - self.low) * (1 << CURVE_BITS) / spread
        return hilbert_keys(np.clip(cell, 0, (1 << CURVE_BITS) - 1).astype(np.uint32), CURVE_BITS)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of the batches, one unpacked at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _prepare(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, anchor: Column, scale: int) -> DataFrame:
    """id, label, anchor and the integer vector of the rows that take part."""
    x = F.transform(F.col(f"`{vector_col}`"), lambda v: v.cast("double"))
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), anchor.alias("anchor"), x.alias("x")
    ).dropna(subset=["id", "label", "x"])
    whole = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return rows.where(whole).select(
        "id", "label", F.coalesce("anchor", F.lit(False)).alias("anchor"), F.transform("x", lambda v: F.floor(v * scale)).alias("vector")
    )


def _placed(rows: DataFrame, space: _Space) -> DataFrame:
    """The rows with their place on the curve and the vector as bytes."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = np.asarray(lists.flatten())
            full = np.zeros((len(size), space.dims), np.int64)
            first = np.cumsum(size) - size
            row = np.repeat(np.arange(len(size)), size)
            full[row, np.arange(len(flat)) - first[row]] = flat
            keys = space.keys(full)
            store = full.astype(space.store)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array([k.tobytes() for k in keys], pa.binary()), pa.array([v.tobytes() for v in store], pa.binary())],
                ["id", "label", "anchor", "key", "vector"],
            )

    return rows.mapInArrow(place, _ROW)


_PAGE_TYPES = {"page": pa.int64()} | dict.fromkeys(("ids", "labels", "asking", "vectors", "lo", "hi", "label_lo", "label_hi"), pa.binary())


def _paged(placed: DataFrame, space: _Space) -> DataFrame:
    """Pages of rows in curve order, with the zone maps of their blocks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[int, int, bytes, bool]] = []
        last = None

        def page() -> pa.RecordBatch:
            ids, labels = (np.array([r[k] for r in held], np.int64) for k in (0, 1))
            vectors = np.frombuffer(b"".join(r[2] for r in held), space.store).reshape(-1, space.dims)
            at = np.arange(0, len(held), BLOCK_ROWS)
            asking = np.array([r[3] for r in held], np.uint8)
            parts = [ids, labels, asking, vectors, np.minimum.reduceat(vectors, at), np.maximum.reduceat(vectors, at)]
            parts += [np.minimum.reduceat(labels, at), np.maximum.reduceat(labels, at)]
            return _rows({k: [v] for k, v in zip(_PAGE_TYPES, [number] + [p.tobytes() for p in parts], strict=True)}, _PAGE_TYPES)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in (0, 1, 4, 2)), strict=True):
                if row[:3] == last:
                    continue
                last = row[:3]
                held.append(row)
                if len(held) == space.page_rows:
                    yield page()
                    held, number = [], number + 1
        if held:
            yield page()

    return (
        placed.repartitionByRange("key", "id")
        .sortWithinPartitions("key", "id", "label", "vector", F.col("anchor").desc())
        .mapInArrow(pack, _PAGE)
    )


_SEED_TYPES = {"id": pa.int64(), "label": pa.int64(), "key": pa.binary(), "vector": pa.binary(), "low": pa.int64()}


def _first_scores(pages: DataFrame, space: _Space, positives: int) -> DataFrame:
    """The anchors, each with the score of the last positive that its own page gives (the least number if it has fewer)."""

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for page in _each(batches):
            ids, labels = np.frombuffer(page["ids"], np.int64), np.frombuffer(page["labels"], np.int64)
            stored = np.frombuffer(page["vectors"], space.store).reshape(-1, space.dims)
            asking = np.flatnonzero(np.frombuffer(page["asking"], np.uint8))
            vectors, lows = stored.astype(space.work), []
            for i in asking:
                near = (vectors @ vectors[i])[(labels == labels[i]) & (ids != ids[i])]
                lows.append(int(np.partition(near, -positives)[-positives]) if len(near) >= positives else _LEAST)
            own = stored[asking]
            columns = [ids[asking], labels[asking], [k.tobytes() for k in space.keys(own)], [v.tobytes() for v in own], lows]
            yield _rows(dict(zip(_SEED_TYPES, columns, strict=True)), _SEED_TYPES)

    read = pages.select("page", "ids", "labels", "asking", "vectors")
    return read.mapInArrow(seed, "id long, label long, key binary, vector binary, low long").withColumn(
        "uid", F.xxhash64("id", "label", "vector")
    )


_ANCHOR_TYPES = dict.fromkeys(("ids", "keys", "labels", "vectors", "lows", "highs"), pa.binary())


def _packed_anchors(anchors: DataFrame, space: _Space) -> DataFrame:
    """Anchors (id, uid, label, key, vector, lows, highs) in curve order, packed; every anchor's windows have the same number."""
    most = max(1, PACK_BYTES // (space.dims * space.store.itemsize))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                rows = batch.slice(at, most)
                plain = [rows.column(k).to_numpy().tobytes() for k in ("id", "uid", "label")]
                vectors = b"".join(rows.column("vector").to_pylist())
                windows = [np.asarray(rows.column(k).flatten()).astype(np.int64).tobytes() for k in ("lows", "highs")]
                yield _rows({k: [v] for k, v in zip(_ANCHOR_TYPES, [*plain, vectors, *windows], strict=True)}, _ANCHOR_TYPES)

    ordered = anchors.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    return ordered.select("id", "uid", "label", "vector", "lows", "highs").mapInArrow(pack, _ANCHORS)


_ZONE_TYPES = dict.fromkeys(("pages", "lo", "hi", "label_lo", "label_hi"), pa.binary())


def _packed_zones(pages: DataFrame) -> DataFrame:
    """Zone maps of many pages in one row; ``pages`` names the page of each block."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[bytes]] = []

        def zones() -> pa.RecordBatch:
            return _rows({k: [b"".join(h[i] for h in held)] for i, k in enumerate(_ZONE_TYPES)}, _ZONE_TYPES)

        for page in _each(batches):
            blocks = len(page["label_lo"]) // 8
            held.append([np.full(blocks, page["page"]).tobytes(), *(page[k] for k in ("lo", "hi", "label_lo", "label_hi"))])
            if sum(len(h[1]) for h in held) >= PACK_BYTES:
                yield zones()
                held = []
        if held:
            yield zones()

    return pages.select("page", "lo", "hi", "label_lo", "label_hi").mapInArrow(
        pack, "pages binary, lo binary, hi binary, label_lo binary, label_hi binary"
    )


class _Asked:
    """Packed anchors, unpacked."""

    def __init__(self, row: dict, space: _Space):
        self.row, self.space = row, space
        self.ids, self.keys, self.labels = (np.frombuffer(row[k], np.int64) for k in ("ids", "keys", "labels"))
        self.vectors = space.read(row["vectors"])
        self.lows, self.highs = (np.frombuffer(row[k], np.int64).reshape(len(self.ids), -1) for k in ("lows", "highs"))

    def part(self, chosen: np.ndarray) -> dict[str, bytes]:
        plain = {k: getattr(self, k)[chosen].tobytes() for k in ("ids", "keys", "labels", "lows", "highs")}
        return plain | {"vectors": self.vectors[chosen].astype(self.space.store).tobytes()}


def _chosen(anchors: DataFrame, zones: DataFrame, space: _Space, same_label: bool) -> DataFrame:
    """(page, packed anchors, block mask of each) where a block's bounds meet a window of the anchor."""
    packs = zones.count()
    spread = anchors.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(max(packs, 1) - 1))))
    dealt = zones.withColumn("pack", F.pmod(F.xxhash64("pages"), F.lit(max(packs, 1))).cast("int"))
    types = {"page": pa.int64()} | _ANCHOR_TYPES | {"blocks": pa.binary()}

    def fits(asked: _Asked, lo: np.ndarray, hi: np.ndarray, label_lo: np.ndarray, label_hi: np.ndarray) -> np.ndarray:
        """For each anchor, the blocks of a page that can hold a row of one of its windows; some anchors at a time."""
        out = np.empty((len(asked.ids), len(lo)), bool)
        step = max(1, CELLS // len(lo))
        for a in range(0, len(out), step):
            own = slice(a, a + step)
            least, most = bounds(asked.vectors[own], lo, hi)
            label = asked.labels[own, None]
            same = (label_lo <= label) & (label <= label_hi) if same_label else (label_lo != label) | (label_hi != label)
            meets = np.zeros(same.shape, bool)
            for low, high in zip(asked.lows[own].T, asked.highs[own].T, strict=True):
                meets |= (most >= low[:, None]) & (least <= high[:, None]) & (low <= high)[:, None]
            out[own] = same & meets
        return out

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            asked = _Asked({k: row[k] for k in _ANCHOR_TYPES}, space)
            zone = [space.read(row[k]) for k in ("lo", "hi")] + [np.frombuffer(row[k], np.int64) for k in ("label_lo", "label_hi")]
            of = np.frombuffer(row["pages"], np.int64)
            cut = np.append(0, np.flatnonzero(np.diff(of)) + 1)
            for a, b in zip(cut, np.append(cut[1:], len(of)), strict=True):
                blocks = fits(asked, *(z[a:b] for z in zone))
                chosen = np.flatnonzero(blocks.any(axis=1))
                if len(chosen):
                    out = {"page": int(of[a]), **asked.part(chosen), "blocks": np.packbits(blocks[chosen], axis=1).tobytes()}
                    yield _rows({k: [v] for k, v in out.items()}, {k: types[k] for k in out})

    schema = "page long, ids binary, keys binary, labels binary, lows binary, highs binary, vectors binary, blocks binary"
    return spread.join(dealt, "pack").select(*_ANCHOR_TYPES, "pages", "lo", "hi", "label_lo", "label_hi").mapInArrow(choose, schema)


def _of_page(
    q: _Asked, own: slice, mask: np.ndarray, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray, none: float, same_label: bool, count: int
) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(anchor, window, row ids, scores): the best ``count`` rows of a page in each window of the anchors ``own``; ``scores`` is used up.

    ``count`` blocks whose best score is not above the lowest upper end hold
    ``count`` rows from the least of these scores on, so lower rows are in no
    window's result.
    """
    starts = np.arange(0, len(ids), BLOCK_ROWS)
    fitting = {label: labels == label if same_label else labels != label for label in np.unique(q.labels[own]).tolist()}
    found = []
    for i, s, blocks in zip(range(own.start, own.start + len(scores)), scores, mask, strict=True):
        real = q.lows[i] <= q.highs[i]
        if not real.any():
            continue
        fits = fitting[int(q.labels[i])]
        if not blocks.all():
            fits = fits & np.repeat(blocks, BLOCK_ROWS)[: len(ids)]
        if same_label:
            fits = fits & (ids != q.ids[i])
        s[~fits] = none
        # in the type of the scores, which holds every score exactly
        low, end, high = (s.dtype.type(v) for v in (q.lows[i][real].min(), q.highs[i][real].min(), q.highs[i][real].max()))
        tops = np.maximum.reduceat(np.where(s <= end, s, none), starts)
        if len(tops) >= count:
            low = max(low, np.partition(tops, -count)[-count])
        some = np.flatnonzero((s >= low) & (s <= high))
        got = s[some].astype(np.int64)
        order = np.lexsort((ids[some], -got))
        some, got = some[order], got[order]
        for w, (lo, hi) in enumerate(zip(q.lows[i], q.highs[i], strict=True)):
            a, b = np.searchsorted(-got, -hi), np.searchsorted(-got, -lo, "right")
            b = min(a + count, b)
            if a < b:
                found.append((i, w, ids[some[a:b]], got[a:b]))
    return found


def _best(asked: DataFrame, pages: DataFrame, space: _Space, same_label: bool, count: int) -> DataFrame:
    """(anchor id, key, window, row id, score): the best ``count`` rows of every window in each chosen page."""
    held = pages.select("page", F.col("ids").alias("page_ids"), F.col("labels").alias("page_labels"), F.col("vectors").alias("page_vectors"))
    types = {"anchor": pa.int64(), "uid": pa.int64(), "window": pa.int32(), "id": pa.int64(), "score": pa.int64()}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            q = _Asked({k: row[k] for k in _ANCHOR_TYPES}, space)
            ids, labels = np.frombuffer(row["page_ids"], np.int64), np.frombuffer(row["page_labels"], np.int64)
            blocks = -(-len(ids) // BLOCK_ROWS)
            mask = np.unpackbits(np.frombuffer(row["blocks"], np.uint8).reshape(len(q.ids), -1), axis=1, count=blocks).astype(bool)
            read = np.repeat(mask.any(axis=0), BLOCK_ROWS)[: len(ids)]
            ids, labels, mask = ids[read], labels[read], mask[:, mask.any(axis=0)]
            vectors = space.read(row["page_vectors"])[read]
            step = max(1, CELLS // len(ids))
            for a in range(0, len(q.ids), step):
                own = slice(a, a + step)
                found = _of_page(q, own, mask[own], q.vectors[own] @ vectors.T, ids, labels, space.none, same_label, count)
                n = [len(f[2]) for f in found]
                who = np.repeat([f[0] for f in found], n).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(q.ids[who]),
                        pa.array(q.keys[who]),
                        pa.array(np.repeat([f[1] for f in found], n).astype(np.int32)),
                        *(pa.array(np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)])) for k in (2, 3)),
                    ],
                    list(types),
                )

    joined = asked.join(held, "page").drop("page")
    return joined.mapInArrow(score, "anchor long, uid long, window int, id long, score long")


def _ranked(found: DataFrame, count: int) -> DataFrame:
    """The best ``count`` rows of each window over all pages, with their rank."""
    order = Window.partitionBy("anchor", "uid", "window").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def mine(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For every row for which ``anchor`` holds: its first ``positives`` rows of
    the same label by inner product, and for each the first ``negatives`` rows
    of other labels scoring from ``low`` to ``high`` percent of it.
    """
    spark = vectors.sparkSession
    rows = _prepare(vectors, id_col, vector_col, label_col, anchor, scale)
    size = rows.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.min(F.array_min("vector")), F.max(F.array_max("vector"))).first()
    if not size[0]:
        return spark.createDataFrame([], _OUT)
    space = _Space(size[1], size[2] or 0, size[3] or 0)
    pages = write_intermediate(_paged(_placed(rows, space), space), "hilbert-pages")
    seeds = write_intermediate(_first_scores(pages, space, positives), "anchors")
    zones = write_intermediate(_packed_zones(pages), "zone-maps")

    first = seeds.withColumn("lows", F.array("low")).withColumn("highs", F.array(F.lit(_MOST)))
    found = _best(_chosen(_packed_anchors(first, space), zones, space, True), pages, space, True, positives)
    near = write_intermediate(_ranked(found, positives).select("anchor", "uid", F.col("rank").alias("place"), "id", "score"), "positives")

    # integer bounds of the windows; unused places of an anchor get an empty window
    def of(place: int, value: str) -> Column:
        return F.max(F.when(F.col("place") == place, F.col(value)))

    lows = [F.coalesce(of(p, "low"), F.lit(1)).cast("long") for p in range(1, positives + 1)]
    highs = [F.coalesce(of(p, "high"), F.lit(0)).cast("long") for p in range(1, positives + 1)]
    bound = near.withColumn("low", F.expr(f"-((-score * {low} - pmod(-score * {low}, 100)) div 100)")).withColumn(
        "high", F.expr(f"(score * {high} - pmod(score * {high}, 100)) div 100")
    )
    windows = bound.groupBy(F.col("anchor").alias("id"), "uid").agg(F.array(*lows).alias("lows"), F.array(*highs).alias("highs"))
    with_windows = seeds.drop("low").join(windows, ["id", "uid"])
    found = _best(_chosen(_packed_anchors(with_windows, space), zones, space, False), pages, space, False, negatives)
    far = _ranked(found, negatives).withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
    named = near.select("anchor", "uid", (F.col("place") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = write_intermediate(
        far.join(named, ["anchor", "uid", "window"]).select(
            F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        ),
        "hard-negatives",
    )
    for done in (pages, seeds, zones, near):
        discard(done)
    return out
