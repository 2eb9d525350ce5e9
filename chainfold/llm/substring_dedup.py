"""Exact substring deduplication over fixed-block anchors.

Every document is cut into non-overlapping reference blocks of
``(window + 1) // 2`` words, and every rolling window of that many words
probes the index of those blocks. Any ``window`` consecutive words hold one
whole reference block, so a passage shared by two documents is hit on both
sides. Hits are then extended: all ``window``-word sequences around a hit are
compared with the same sequences of the other documents, and the union of
those that also start in a document with a smaller id are the maximal exact
repeats, which are removed. Windows are judged on the input.

How it runs: hashes are dealt by range. A task sends one packed row per range
(four bytes of hash remainder for each window, runs for the documents), and
answers come back packed by document chunk. The number of ranges grows with
the text, so a group stays at some megabytes; a hot passage adds one entry
per window and document, and is never paired with its other copies.

Edge cases: null and empty texts have no words (``n_words`` 0, hash of the
empty string). Rows with a null id are neither reference nor cleaned. Rows
that repeat an id are one document for "a smaller id": they don't remove each
other's text. Words are kept as they are and joined by one space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainfold.llm import blocks as B
from chainfold.storage import discard, write_intermediate

GROUP_BYTES = 12 << 20
PACK_BYTES = 16 << 20
LEAST_RANGES = 256
MOST_RANGES = 1 << 18
_PACKED = "slot int, docs binary, sizes binary, hashes binary"
_ANSWER = "chunk int, docs binary, hashes binary"


def _ranges(docs: DataFrame, text: str) -> int:
    """A power of two that grows with the text, so that a range's windows stay near GROUP_BYTES."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    want = max(LEAST_RANGES, min(MOST_RANGES, size // GROUP_BYTES))
    return 1 << (int(want) - 1).bit_length()


def _within(offsets: np.ndarray, i: int, j: int) -> Iterator[tuple[int, int]]:
    for a, b in B.spans(offsets[i : j + 1]):
        yield i + a, i + b


def _pack(slots: np.ndarray, rest: np.ndarray, docs: np.ndarray) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """(slot, ids, run lengths, remainders) of each slot; ``docs`` ascends in runs."""
    order = np.argsort(slots, kind="stable")
    slots, rest, docs = slots[order], rest[order], docs[order]
    cut = np.flatnonzero(np.diff(slots)) + 1
    for a, b in zip(np.append(0, cut), np.append(cut, len(slots)), strict=True):
        if b > a:
            turn = np.append(0, np.flatnonzero(np.diff(docs[a:b])) + 1)
            sizes = np.diff(np.append(turn, b - a)).astype(np.uint32)
            yield int(slots[a]), docs[a:b][turn].tobytes(), sizes.tobytes(), rest[a:b].tobytes()


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.int32()] + [pa.binary()] * (len(names) - 1)
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _unpack(batches, width: type) -> tuple[np.ndarray, np.ndarray]:
    """(hash, doc) of all packed rows of a group."""
    hashes, docs = [], []
    for batch in batches:
        for d, s, h in zip(*(batch.column(k) for k in ("docs", "sizes", "hashes")), strict=True):
            hashes.append(np.frombuffer(h.as_buffer(), width))
            docs.append(np.repeat(np.frombuffer(d.as_buffer(), np.int64), np.frombuffer(s.as_buffer(), np.uint32)))
    return np.concatenate(hashes), np.concatenate(docs)


def _answers(hashes: np.ndarray, docs: np.ndarray, slot: int, shift: int, chunks: int) -> pa.RecordBatch:
    """Hits of one range, packed by document chunk; a hash and document once."""
    full = hashes.astype(np.uint64) | (np.uint64(slot) << np.uint64(shift)) if shift < 64 else hashes
    chunk = _chunk(docs, chunks)
    order = np.lexsort((full, docs, chunk))
    full, docs, chunk = full[order], docs[order], chunk[order]
    cut = np.append(0, np.flatnonzero(np.diff(chunk)) + 1) if len(chunk) else np.zeros(0, np.int64)
    ends = np.append(cut[1:], len(chunk))
    return _batch(
        [(int(chunk[a]), docs[a:b].tobytes(), full[a:b].tobytes()) for a, b in zip(cut, ends, strict=False)],
        ["chunk", "docs", "hashes"],
    )


def _chunk(docs: np.ndarray, chunks: int) -> np.ndarray:
    return (B.mix(docs.view(np.uint64)) & np.uint64(chunks - 1)).astype(np.int32)


def _hit_map(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(docs, hashes) of a chunk's answers, sorted by document."""
    docs = [np.frombuffer(x.as_buffer(), np.int64) for x in table.column("docs").combine_chunks()]
    hashes = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("hashes").combine_chunks()]
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    docs, hashes = np.concatenate(docs), np.concatenate(hashes)
    order = np.argsort(docs, kind="stable")
    return docs[order], hashes[order]


def _in_chunk(table: pa.Table) -> Iterator[tuple[int, int | None, B.Words, int]]:
    """(row, id, words, index in the block) of each document of a chunk."""
    offsets, data = B.text_arrays(table.column("text"))
    ids = table.column("doc_id").to_pylist()
    for i, j in B.spans(offsets):
        words = B.split_words(offsets[i : j + 1], data[offsets[i] : offsets[j]])
        for row in range(i, j):
            yield row, ids[row], words, row - i


def repeated_windows(docs: DataFrame, id_col: str, text_col: str, window: int) -> tuple[DataFrame, int]:
    """Packed (chunk, docs, hashes) of the window hashes to remove in each document, and the number of chunks."""
    block = (window + 1) // 2
    ranges = _ranges(docs, text_col)
    bits = ranges.bit_length() - 1
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = texts.where("doc_id is not null")

    def mark(offsets: np.ndarray, data: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(range, remainder, document) of every rolling window; the last bit marks a reference block."""
        words = B.split_words(offsets, data)
        count = np.diff(words.bounds)
        owner = np.repeat(np.arange(len(ids), dtype=np.int32), count)
        grams = B.ngrams(words.hashes, block)
        owner = owner[: len(grams)]
        place = np.arange(len(owner)) - words.bounds[owner]
        fits = place + block <= count[owner]
        grams, owner, place = grams[fits], owner[fits], place[fits]
        marked = ((grams >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFE)) | (place % block == 0)
        return (grams >> np.uint64(64 - bits)).astype(np.int32), marked.astype(np.uint32), ids[owner]

    def probe(batches):
        for batch in batches:
            offsets, data = B.text_arrays(batch.column(1))
            ids = batch.column(0).to_numpy()
            for i, j in B.spans(offsets, PACK_BYTES):
                parts = [mark(offsets[a : b + 1], data[offsets[a] : offsets[b]], ids[a:b]) for a, b in _within(offsets, i, j)]
                rows = list(_pack(*(np.concatenate(p) for p in zip(*parts, strict=True))))
                yield _batch(rows, ["slot", "docs", "sizes", "hashes"])

    def match(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked, docs = _unpack(batches, np.uint32)
        value, anchor = marked >> np.uint32(1), (marked & np.uint32(1)).astype(bool)
        order = np.lexsort((docs, value))
        value, docs, anchor = value[order], docs[order], anchor[order]
        first = np.append(0, np.flatnonzero(np.diff(value)) + 1)
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(value))))
        top = np.iinfo(np.int64).max
        least = np.minimum.reduceat(np.where(anchor, docs, top), first)[group]
        most = np.maximum.reduceat(docs, first)[group]
        hit = (least < docs) | (anchor & (most > docs))
        yield _answers(value[hit].astype(np.uint64), docs[hit], key[0].as_py(), 31, ranges)

    probes = known.mapInArrow(probe, _PACKED)
    hits = write_intermediate(probes.groupBy("slot").applyInArrow(match, _ANSWER), "repeat-hits")

    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        docs, hashes = _hit_map(right)
        rows = []
        if len(docs):
            out_docs, out_grams = [], []
            for _, doc, words, at in _in_chunk(left):
                a, b = np.searchsorted(docs, doc), np.searchsorted(docs, doc, "right")
                own = words.hashes[words.bounds[at] : words.bounds[at + 1]]
                if a == b or len(own) < window:
                    continue
                key = B.ngrams(own, block) >> np.uint64(33 - bits)
                near = np.zeros(len(own) - window + 1, bool)
                for p in np.flatnonzero(np.isin(key, hashes[a:b])):
                    near[max(0, p - window + block) : p + 1] = True
                grams = B.ngrams(own, window)[near]
                out_grams.append(grams)
                out_docs.append(np.full(len(grams), doc))
            if out_docs:
                grams, ids = np.concatenate(out_grams), np.concatenate(out_docs)
                rows = list(_pack((grams >> np.uint64(64 - bits)).astype(np.int32), grams, ids))
        return pa.Table.from_batches([_batch(rows, ["slot", "docs", "sizes", "hashes"])])

    def judge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, docs = _unpack(batches, np.uint64)
        order = np.lexsort((docs, grams))
        grams, docs = grams[order], docs[order]
        first = np.append(0, np.flatnonzero(np.diff(grams)) + 1)
        least = np.repeat(docs[first], np.diff(np.append(first, len(grams))))
        later = least < docs
        yield _answers(grams[later], docs[later], 0, 64, ranges)

    candidates = _with_chunk(known, ranges).groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(extend, _PACKED)
    repeats = write_intermediate(candidates.groupBy("slot").applyInArrow(judge, _ANSWER), "repeats")
    discard(hits)
    return repeats, ranges


def _with_chunk(texts: DataFrame, chunks: int) -> DataFrame:
    """Adds the chunk that ``_chunk`` gives a document (the same number computed batch by batch)."""

    def number(batches):
        for batch in batches:
            ids = batch.column(0)
            chunk = _chunk(np.ascontiguousarray(ids.fill_null(0).to_numpy()), chunks)
            yield pa.RecordBatch.from_arrays([ids, batch.column(1), pa.array(chunk)], ["doc_id", "text", "chunk"])

    return texts.mapInArrow(number, "doc_id long, text string, chunk int")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text, removed (word ranges, end exclusive) of every row."""
    if window < 3:
        raise ValueError("window must be 3 words or more")
    repeats, chunks = repeated_windows(docs, id_col, text_col, window)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def clean(left: pa.Table, right: pa.Table) -> pa.Table:
        docs, hashes = _hit_map(right)
        out = []
        for _, doc, words, at in _in_chunk(left):
            lo, hi = words.bounds[at], words.bounds[at + 1]
            gone = np.zeros(hi - lo, bool)
            a, b = (np.searchsorted(docs, doc), np.searchsorted(docs, doc, "right")) if doc is not None else (0, 0)
            if a < b:
                for p in np.flatnonzero(np.isin(B.ngrams(words.hashes[lo:hi], window), hashes[a:b])):
                    gone[p : p + window] = True
            step = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
            kept = b" ".join(words.data[s:e].tobytes() for s, e in zip(words.starts[lo:hi][~gone], words.ends[lo:hi][~gone], strict=True))
            out.append((doc, hi - lo, int(gone.sum()), kept.decode("utf-8", "replace"), step.reshape(-1, 2).tolist()))
        names = ["doc_id", "n_words", "n_removed", "kept_text", "removed"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64()))]
        columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return (
        _with_chunk(texts, chunks)
        .groupBy("chunk")
        .cogroup(repeats.groupBy("chunk"))
        .applyInArrow(clean, "doc_id long, n_words long, n_removed long, kept_text string, removed array<array<bigint>>")
    )


