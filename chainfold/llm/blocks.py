"""Vectorised word and n-gram hashing over Arrow text columns.

A word is a maximal run of bytes other than space and ``\\x09-\\x0D``. Texts
are worked through in blocks of a few megabytes, so memory does not grow
with the batch; one document is never split. All hashes are 64-bit and the
same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

BLOCK_BYTES = 2 << 20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _stream(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


_BYTE = _stream(256, 17)
_STEP = _U(0x9E3779B97F4A7C55)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def text_arrays(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0] : offsets[-1]]


def spans(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


@dataclass
class Words:
    """The words of a block of documents.

    ``hashes`` holds one hash per word; the words of document ``d`` are
    ``bounds[d]:bounds[d + 1]``; ``starts`` and ``ends`` are byte positions
    in ``data``.
    """

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray


def split_words(offsets: np.ndarray, data: np.ndarray, lower: bool = False, space: np.ndarray = _SPACE) -> Words:
    """Words of the documents; ``space`` marks the bytes (of 256) that part them."""
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return Words(data, empty, empty, np.zeros(len(offsets), np.int64), np.zeros(0, _U))
    word = ~space[data]
    first = np.empty(n, bool)
    first[0] = True
    np.logical_not(word[:-1], out=first[1:])
    edges = offsets[:-1]
    first[edges[edges < n]] = True
    first &= word
    starts = np.flatnonzero(first)
    body = data[word]
    # each word's place among the word bytes
    at = np.flatnonzero(first[word])
    lengths = np.diff(np.append(at, len(body)))
    hashes = hash_runs(body, at, lengths)
    bounds = np.searchsorted(starts, offsets)
    return Words(data, starts, starts + lengths, bounds, hashes)


def hash_runs(body: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each run ``body[at[i]:at[i] + lengths[i]]``; runs are adjacent and not empty."""
    if not len(at):
        return np.zeros(0, _U)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(lengths.max()), _STEP))
        place = np.arange(len(body), dtype=np.int32)
        place -= np.repeat(at.astype(np.int32), lengths)
        codes = _BYTE[body]
        codes *= power[place]
        return mix(np.add.reduceat(codes, at) + lengths.astype(_U))


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words starting at each word, regardless of documents."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, _U)
    factors = _stream(n, 1000 + n)
    with np.errstate(over="ignore"):
        out = hashes[:m] * factors[0]
        for j in range(1, n):
            out += hashes[j : m + j] * factors[j]
    return mix(out)


def whole(hashes: np.ndarray) -> np.uint64:
    """Hash of a word sequence of any length."""
    factors = _stream(len(hashes), 7)
    with np.errstate(over="ignore"):
        return mix(np.array([(hashes * factors).sum() + _U(len(hashes))], _U))[0]


def long_array(values: list[np.ndarray]) -> pa.Array:
    """array<long> column from one uint64 array per row."""
    lengths = np.fromiter((len(v) for v in values), np.int64, len(values))
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, _U)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def with_field(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    """A copy of ``schema`` with one more field."""
    return T.StructType([*schema.fields, T.StructField(name, kind)])
