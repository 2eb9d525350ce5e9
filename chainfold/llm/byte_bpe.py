"""Byte-level BPE by merge replay over the distinct words of a block of the corpus.

The pieces that the split pattern gives are counted once per block of
documents. All distinct pieces of the block lie in one symbol array, and an
inverted index maps each adjacent token pair, by the rank of the token it
merges into, to its positions. Merges are applied in rank order, each at all
its positions at once, and only the touched neighbours get new index entries.
Documents are then gathered from the encoded pieces. A block is a bounded
number of bytes of whole documents, so tasks need no shuffle and a lost task
is redone by itself; the result does not depend on the blocks.

Texts are encoded whole and without special tokens; null texts are empty.
Decoding gives back the exact bytes. Ids outside the vocabulary raise.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainfold.llm import blocks as B

BLOCK_BYTES = 6 << 20
DECODE_TOKENS = 400_000

# Fixed value: the split pattern of the public byte-level vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Vocabulary:
    """Token bytes by rank, and every split of a token into two others."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.size = size
        self.known = np.array([bool(t) for t in tokens])
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left * size + right)
                    merged.append(rank)
        order = np.argsort(np.array(pairs, np.int64))
        self.pairs = np.array(pairs, np.int64)[order]
        self.merged = np.array(merged, np.int64)[order]

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token each pair merges into, -1 where none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.merged[at], -1)


@lru_cache(maxsize=4)
def load_vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


def replay_merges(pieces: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(token ids of all pieces one after another, offsets by piece)."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    edges = np.concatenate([[0], np.cumsum(sizes)])
    n = int(edges[-1])
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(pieces) + 1, np.int64)
    symbol = vocab.single[np.frombuffer(b"".join(pieces), np.uint8)]
    after = np.arange(1, n + 1)
    after[edges[1:][sizes > 0] - 1] = -1
    before = np.arange(-1, n - 1)
    before[edges[:-1][sizes > 0]] = -1

    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []
    target = np.full(n, -1)  # what the pair that starts here merges into now

    def enter(places: np.ndarray) -> None:
        """Index the pairs that start at ``places`` under the token they merge into."""
        target[places] = -1
        places = places[after[places] >= 0]
        made = vocab.merge(symbol[places], symbol[after[places]])
        target[places] = made
        places, made = places[made >= 0], made[made >= 0]
        if not len(places):
            return
        order = np.argsort(made, kind="stable")
        places, made = places[order], made[order]
        cut = np.flatnonzero(np.diff(made)) + 1
        for rank, part in zip(made[np.append(0, cut)].tolist(), np.split(places, cut), strict=True):
            if rank not in index:
                index[rank] = []
                heapq.heappush(queue, rank)
            index[rank].append(part)

    enter(np.arange(n))
    alive = np.ones(n, bool)
    while queue:
        rank = heapq.heappop(queue)
        parts = index.pop(rank)
        places = np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
        places = places[target[places] == rank]
        if not len(places):
            continue
        right = after[places]
        if len(places) > 1 and (right[:-1] == places[1:]).any():
            # overlapping pairs of one rank: leftmost first
            keep, taken = [], -1
            for p, r in zip(places.tolist(), right.tolist(), strict=True):
                if p != taken:
                    keep.append(p)
                    taken = r
            places = np.array(keep)
            right = after[places]
        symbol[places] = rank
        alive[right] = False
        target[right] = -1
        follow = after[right]
        after[places] = follow
        before[follow[follow >= 0]] = places[follow >= 0]
        left = before[places]
        enter(np.unique(np.concatenate([places, left[left >= 0]])))
    kept = np.concatenate([[0], np.cumsum(alive)])
    return symbol[alive], kept[edges]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """0 other, 1 letter, 2 number, 3 white space, for every code point, as the pattern's library has them."""
    out = np.zeros(0x110000, np.uint8)
    points = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, cls in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\s+")):
        for m in regex.finditer(cls, points):
            a, b = ord(m[0][0]), ord(m[0][-1])
            out[a : b + 1] = kind
    out[0xD800:0xE000] = 0
    return out


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, byte position of each) of valid UTF-8."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.int32)
    if (data < 0x80).all():
        return lead, at
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32) & 0x3F
    one, two, three = padded[at + 1], padded[at + 2], padded[at + 3]
    out = np.where(lead < 0x80, lead, (lead & 0x1F) << 6 | one)
    out = np.where(lead >= 0xE0, (lead & 0x0F) << 12 | one << 6 | two, out)
    return np.where(lead >= 0xF0, (lead & 0x07) << 18 | one << 12 | two << 6 | three, out), at


def split_block(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Byte positions where a piece of ``SPLIT`` starts, in whole documents one after another.

    Runs of one class are pieces; the last space before a run belongs to it,
    other white space before it is cut off by the look-ahead; a single
    apostrophe that starts a piece takes the letters of a contraction.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    points, at = _code_points(data)
    n = len(points)
    cls = _classes()[points]
    edge = np.zeros(n + 1, bool)
    edge[np.searchsorted(at, offsets)] = True  # documents
    edge[n] = True
    start = edge[:n].copy()
    start[1:] |= cls[1:] != cls[:-1]
    begins = np.flatnonzero(start)
    ends = np.append(begins[1:], n)
    space = cls[begins] == 3
    followed = space & ~edge[ends]
    last = ends[followed] - 1
    start[last] = True
    joined = last[points[last] == 32]
    start[joined + 1] = False  # the space and the run after it are one piece
    # contractions
    quote = np.flatnonzero((points[:-1] == 39) & start[:-1] & start[1:] & (cls[1:] == 1) & ~edge[1:n]) if n > 1 else begins[:0]
    if len(quote):
        ahead = np.append(points, [0, 0])
        inner = np.append(edge, True)
        one, two = ahead[quote + 1], np.where(inner[quote + 2], 0, ahead[quote + 2])
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = np.isin(one * 256 + np.minimum(two, 255), [ord(c[0]) * 256 + ord(c[1]) for c in ("re", "ve", "ll")])
        width = np.where(single, 1, np.where(double, 2, 0))
        quote, width = quote[width > 0], width[width > 0]
        start[quote + 1] = False
        rest = quote + 1 + width
        rest = rest[rest < n]
        start[rest] = True
    return at[start]


def gather(values: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``which`` of a ragged array one after another, and the lengths of the runs."""
    lengths = (offsets[1:] - offsets[:-1])[which]
    starts = np.repeat(offsets[:-1][which] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) if len(which) else lengths
    return values[starts + np.arange(len(starts))] if len(which) else values[:0], lengths


def _pieces(
    offsets: np.ndarray, data: np.ndarray, texts: pa.Array, split: regex.Pattern
) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct pieces, piece of each place, number of places by document) of a block.

    ``SPLIT`` is worked out on arrays, and equal pieces are told by their
    64-bit hashes; any other pattern goes through the regex library.
    """
    if split.pattern != SPLIT:
        seen: dict[str, int] = {}
        words, counts = [], []
        for text in texts.to_pylist():
            found = split.findall(text or "")
            counts.append(len(found))
            words += [seen.setdefault(w, len(seen)) for w in found]
        return [w.encode() for w in seen], np.array(words, np.int64), np.array(counts, np.int64)
    keys, starts, ends, counts = [], [], [], []
    for a, b in B.spans(offsets):
        part = data[offsets[a] : offsets[b]]
        cut = split_block(offsets[a : b + 1] - offsets[a], part)
        keys.append(B.hash_runs(part, cut, np.diff(np.append(cut, len(part)))))
        starts.append(cut + offsets[a])
        ends.append(np.append(cut[1:], len(part)) + offsets[a])
        counts.append(np.diff(np.searchsorted(cut, offsets[a : b + 1] - offsets[a])))
    _, first, which = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    raw, start, end = data.tobytes(), np.concatenate(starts)[first].tolist(), np.concatenate(ends)[first].tolist()
    return [raw[s:e] for s, e in zip(start, end, strict=True)], which, np.concatenate(counts)


def _list(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


def encode(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` without its text column, with ``ids`` (array<int>) in its place.

    Every other column is kept as it is; a column already called ``ids_col``
    is replaced.
    """
    others = [c for c in docs.columns if c not in (text_col, ids_col)]
    rows = docs.select(*(F.col(f"`{c}`") for c in others), F.col(f"`{text_col}`").alias("__text"))
    schema = B.with_field(rows.drop("__text").schema, ids_col, T.ArrayType(T.IntegerType()))
    split = regex.compile(pattern)

    def run(batches):
        vocab = load_vocabulary(rank_file)
        for batch in batches:
            texts = batch.column(len(others))
            offsets, data = B.text_arrays(texts)
            for i, j in B.spans(offsets, BLOCK_BYTES):
                pieces, which, counts = _pieces(offsets[i : j + 1], data, texts.slice(i, j - i), split)
                tokens, at = replay_merges(pieces, vocab)
                ids, lengths = gather(tokens.astype(np.int32), at, which)
                edge = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(i, j - i) for k in range(len(others))] + [_list(ids, np.diff(edge))],
                    [*others, ids_col],
                )

    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, rank_file: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``tokens`` with ``bytes_col`` (binary), the bytes of the token ids; null ids are empty."""
    others = [c for c in tokens.columns if c != bytes_col]
    rows = tokens.select(*(F.col(f"`{c}`") for c in others))
    place = others.index(ids_col)

    def run(batches):
        vocab = load_vocabulary(rank_file)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(place)), 0).to_numpy()
            for i, j in B.spans(np.concatenate([[0], np.cumsum(sizes)]), DECODE_TOKENS):
                part = batch.slice(i, j - i)
                flat = part.column(place).flatten()
                if flat.null_count:
                    raise ValueError("a token id is null")
                flat = flat.to_numpy()
                if len(flat) and (flat.min() < 0 or flat.max() >= vocab.size or not vocab.known[flat].all()):
                    raise ValueError("a token id is not in the vocabulary")
                data, lengths = gather(vocab.bytes, vocab.offsets, flat)
                edge = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(sizes[i:j])])]
                out = pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(edge.astype(np.int64)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([*part.columns, out.cast(pa.binary())], [*others, bytes_col])

    return rows.mapInArrow(run, B.with_field(rows.schema, bytes_col, T.BinaryType()))
