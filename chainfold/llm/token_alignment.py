"""Alignment of two tokenizers' tokens over the same texts, with corpus-wide counts of linked ids.

Both tokenizers encode a space and the text. A token ends at a byte offset of
that string; offsets where tokens of both end cut the tokens into groups, and
the two tokens that end there are linked. The shorter list of ends drives a
galloping search of the longer one: from the rank found for its
neighbourhood, steps double until the end is passed, then halve. Ranks of
common ends slice the groups; differences of ranks are the tokens a group
spans on either side.

The count of an id pair is the number of links that hold it in the whole
corpus. For each document: the sum of its links' counts, and how many links
have the highest count among all pairs of their second id (ties included).

How it runs: one pass encodes and aligns and writes the ids with one bit a
token (last of its group) to the checkpoint folder; a second pass counts
pairs, pre-aggregated in the tasks; a third reads the ids again with the
counts. Documents are never shuffled. The counts are collected and broadcast:
two tokens with a common end stand for bytes of which one is a suffix of the
other, so there are at most as many pairs as both vocabularies have bytes
(times two for byte tokens), however large the corpus is.

Edge cases: null and empty texts, and texts that either tokenizer does not
give back byte for byte, have no tokens: all numbers are 0 and ``groups`` is
empty. Rows with a null or repeated id are rows of their own. Long texts are
encoded in pieces cut between a letter and a space before a letter, where
neither tokenizer joins tokens. Other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainfold.llm import blocks as B
from chainfold.storage import write_intermediate

#: Characters of one encoded piece of a long text.
PIECE = 1 << 18
#: Bytes of text encoded and aligned at once.
CHUNK_BYTES = 1 << 20
#: Neighbours that share the start of their galloping search.
STRIDE = 32

_GAP = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


@dataclass
class Side:
    """A loaded tokenizer: ``encode`` gives the ids of a list of texts that begin with a space;
    ``flat`` holds the bytes of all tokens, token ``i`` being ``flat[first[i]:first[i] + size[i]]``."""

    encode: Callable[[list[str]], list[list[int]]]
    flat: np.ndarray
    first: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, encode: Callable[[list[str]], list[list[int]]], tokens: list[bytes]) -> Side:
        size = np.array([len(t) for t in tokens], np.int64)
        return cls(encode, np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size)

    @property
    def kind(self) -> type:
        return np.uint16 if len(self.size) <= 1 << 16 else np.uint32

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        shift = self.first[ids] - (np.cumsum(size) - size)
        return self.flat[np.repeat(shift, size) + np.arange(size.sum())]


@lru_cache(maxsize=4)
def load_byte_level(path: str) -> Side:
    """A byte-level BPE from a tokenizers JSON file.

    Entries are merged by the order of their ids, which is the order of the
    file's merges (checked), with tiktoken; pieces too long for its pattern
    matcher go through the tokenizers library.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import tiktoken
    from tokenizers import Tokenizer, pre_tokenizers

    full = Tokenizer.from_file(path)
    full.encode_special_tokens = True
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocabulary = spec["model"]["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    merged = [vocabulary[a + b] for a, b in pairs]
    # the printable stand-in of each byte: itself if it shows, else the next code point from 256 on
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    entries = full.get_vocab(with_added_tokens=True)
    tokens = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        tokens[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
    fast = None
    plain = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    if merged == sorted(merged) and full.normalizer is None and str(full.pre_tokenizer) == str(plain):
        made = set(merged)
        ranks = {tokens[i]: i for i in vocabulary.values() if i in made or len(tokens[i]) == 1}
        fast = tiktoken.Encoding("byte-level", pat_str=_BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        if fast is None:
            return [e.ids for e in full.encode_batch(texts, add_special_tokens=False)]
        return [fast.encode_ordinary(t) if len(t) <= 2 * PIECE else full.encode(t, add_special_tokens=False).ids for t in texts]

    return Side.of(encode, tokens)


# Fixed value: the pre-tokenizer pattern of byte-level BPE files.
_BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def load_pieces(path: str) -> Side:
    """A sentencepiece model that puts a space before the text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    tokens = [bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
    return Side.of(lambda texts: model.encode([t[1:] for t in texts], num_threads=1), tokens)


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """First rank in ``long`` that is not less, for each number of ``short`` (both ascending).

    All numbers move at once: they start at the rank of the first of their
    STRIDE neighbours, double their steps until they are passed, then halve.
    """
    n, m = len(short), len(long)
    start = np.zeros(n, np.int64) if n <= STRIDE else np.repeat(gallop(short[::STRIDE], long), STRIDE)[:n]
    beyond = np.append(long, np.iinfo(np.int64).max)
    low, high, step = start.copy(), start.copy(), 1
    behind = np.flatnonzero(beyond[high] < short)
    while len(behind):
        low[behind] = high[behind] + 1
        high[behind] = np.minimum(high[behind] + step, m)
        behind = behind[beyond[high[behind]] < short[behind]]
        step *= 2
    while (low < high).any():
        middle = (low + high) >> 1
        less = beyond[middle] < short
        low, high = np.where(less, middle + 1, low), np.where(less, high, middle)
    return low


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ranks in ``a``, ranks in ``b``) of the numbers in both ascending lists."""
    if len(a) > len(b):
        ib, ia = common_ends(b, a)
        return ia, ib
    rank = gallop(a, b)
    same = np.append(b, -1)[rank] == a
    return np.flatnonzero(same), rank[same]


def _cut(text: str) -> list[str]:
    """Pieces of a long text, each beginning with a space (as the text does)."""
    out, at = [], 0
    while len(text) - at > PIECE and (gap := _GAP.search(text, at + PIECE)):
        out.append(text[at : gap.start()])
        at = gap.start()
    return [*out, text[at:]]


def _encode(side: Side, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, token bounds of the texts)."""
    pieces = [_cut(t) for t in texts]
    ids = side.encode([p for t in pieces for p in t])
    sizes = np.array([len(x) for x in ids], np.int64)
    bounds = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum([len(t) for t in pieces]))]
    flat = np.fromiter((i for x in ids for i in x), np.int64, int(sizes.sum())) if len(ids) else np.zeros(0, np.int64)
    return flat, bounds


def _token_rows(texts: list[str | None], sides: tuple[Side, Side]) -> list[tuple[bytes, bytes, bytes, bytes]]:
    """Per text: ids of both sides and the bits that mark the last token of each group; empty without tokens."""
    rows = [(b"", b"", b"", b"")] * len(texts)
    some = [i for i, t in enumerate(texts) if t]
    full = [" " + texts[i] for i in some]
    encoded = [_encode(s, full) for s in sides]
    raw = [np.frombuffer(t.encode(), np.uint8) for t in full]
    good = np.ones(len(some), bool)
    for side, (ids, bounds) in zip(sides, encoded, strict=True):
        for k in range(len(some)):
            part = ids[bounds[k] : bounds[k + 1]]
            good[k] &= int(side.size[part].sum()) == len(raw[k]) and np.array_equal(side.joined(part), raw[k])
    for k in np.flatnonzero(~good):
        for j, (ids, bounds) in enumerate(encoded):
            encoded[j] = (np.delete(ids, np.s_[bounds[k] : bounds[k + 1]]), bounds - (bounds > bounds[k]) * (bounds[k + 1] - bounds[k]))
    ends = [np.cumsum(side.size[ids]) for side, (ids, _) in zip(sides, encoded, strict=True)]
    last = []
    for (ids, _), at in zip(encoded, common_ends(*ends), strict=True):
        bits = np.zeros(len(ids), bool)
        bits[at] = True
        last.append(bits)
    for k in np.flatnonzero(good):
        out = []
        for side, (ids, bounds), bits in zip(sides, encoded, last, strict=True):
            own = slice(bounds[k], bounds[k + 1])
            out += [ids[own].astype(side.kind).tobytes(), np.packbits(bits[own]).tobytes()]
        rows[some[k]] = (out[0], out[1], out[2], out[3])
    return rows


_TOKENS = ("a", "a_last", "b", "b_last")


def _unpacked(batch: pa.RecordBatch, sides: tuple[Side, Side]):
    """Per row: (ids, last flags) of both sides."""
    for row in zip(*(batch.column(k).to_pylist() for k in _TOKENS), strict=True):
        out = []
        for side, ids, bits in zip(sides, row[::2], row[1::2], strict=True):
            ids = np.frombuffer(ids, side.kind).astype(np.int64)
            out.append((ids, np.unpackbits(np.frombuffer(bits, np.uint8), count=len(ids)).astype(bool)))
        yield out


def _links(row, width: int) -> np.ndarray:
    (a, a_last), (b, b_last) = row
    return a[a_last] * width + b[b_last]


class _Text:
    """Groups as text: ids of both sides in decimal."""

    def __init__(self, sides: tuple[Side, Side]):
        a, b = (len(s.size) for s in sides)
        self.shift = (0, a, 2 * a, 2 * a + b)
        parts = [(a, ","), (a, "|"), (b, ","), (b, ";")]
        self.words = [f"{i}{mark}" for n, mark in parts for i in range(n)]

    def groups(self, row) -> str:
        (a, a_last), (b, b_last) = row
        if not len(a):
            return ""
        ends_a, ends_b = np.flatnonzero(a_last), np.flatnonzero(b_last)
        spans_a, spans_b = np.diff(ends_a, prepend=-1), np.diff(ends_b, prepend=-1)
        word = np.empty(len(a) + len(b), np.int64)
        word[np.arange(len(a)) + np.repeat(ends_b + 1 - spans_b, spans_a)] = a + np.where(a_last, self.shift[1], self.shift[0])
        word[np.arange(len(b)) + np.repeat(ends_a + 1, spans_b)] = b + np.where(b_last, self.shift[3], self.shift[2])
        return "".join(map(self.words.__getitem__, word.tolist()))[:-1]


@dataclass
class Counts:
    """Links of every pair that is linked somewhere (``key`` is a * width + b), and whether it is its b's highest."""

    keys: np.ndarray
    counts: np.ndarray
    best: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, width: int) -> Counts:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        top = np.zeros(width, np.int64)
        np.maximum.at(top, keys % width, counts)
        return cls(keys, counts, counts == top[keys % width])


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_a, n_b, n_groups, n_links, n_best, count_sum (long) and groups (string) of every row.

    ``a_path`` is a byte-level BPE in a tokenizers JSON file, ``b_path`` a
    sentencepiece model. ``groups`` is ``a1,a2|b1;a3|b2,b3``: the ids of both
    sides of each group in order.
    """
    texts = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = texts.schema[0].dataType.simpleString()
    sides = partial(_sides, a_path, b_path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, _ = B.text_arrays(batch.column(1))
            for i, j in B.spans(offsets, CHUNK_BYTES):
                rows = _token_rows(batch.column(1).slice(i, j - i).to_pylist(), sides())
                columns = [pa.array(c, pa.binary()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *columns], [id_col, *_TOKENS])

    tokens = write_intermediate(
        texts.mapInArrow(encode, f"`{id_col}` {kind}, a binary, a_last binary, b binary, b_last binary"), "token-alignment"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(sides()[1].size)
        for batch in batches:
            keys = np.concatenate([np.zeros(0, np.int64), *(_links(row, width) for row in _unpacked(batch, sides()))])
            keys, n = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pair", "n"])

    pairs = tokens.select(*_TOKENS).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    width = len(load_pieces(b_path).size)
    counted = Counts.of(pairs["pair"].to_numpy().astype(np.int64), pairs["n"].to_numpy().astype(np.int64), width)
    shared = docs.sparkSession.sparkContext.broadcast(counted)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, known = _Text(sides()), shared.value
        for whole in batches:
            sizes = np.append(0, np.cumsum(pc.binary_length(whole.column("a")).to_numpy()))
            for i, j in B.spans(sizes, 2 * CHUNK_BYTES):
                batch, out = whole.slice(i, j - i), []
                for row in _unpacked(batch, sides()):
                    at = np.searchsorted(known.keys, _links(row, width))
                    n = (len(row[0][0]), len(row[1][0]), int(row[0][1].sum()), len(at))
                    out.append((*n, int(known.best[at].sum()), int(known.counts[at].sum()), text.groups(row)))
                columns = list(zip(*out, strict=True))
                arrays = [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [id_col, *_NUMBERS, "groups"])

    return tokens.mapInArrow(judge, f"`{id_col}` {kind}, {', '.join(f'{c} long' for c in _NUMBERS)}, groups string")


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _sides(a_path: str, b_path: str) -> tuple[Side, Side]:
    return load_byte_level(a_path), load_pieces(b_path)
