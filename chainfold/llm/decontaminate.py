"""Benchmark decontamination with suffix arrays over shards of the training text.

A training task turns its documents into word sequences, a shard at a time,
and sorts all suffixes of a shard (prefix doubling; ties only are sorted
again). Every suffix of every test item is then binary-searched, word by
word, all suffixes at once: the range of the suffix array shrinks until the
next word is missing. The depth reached is the longest verbatim match, the
range holds its places. Words no item has can be in no match; they part the
shard, and stretches shorter than the shortest window are left out.

A window is ``window`` consecutive words of an item; an item of fewer words,
but not none, is one window. A document word inside an occurrence of a window
is hit, and a document with a hit is contaminated.

How it runs: one pass over the documents without a shuffle. The items go to
the tasks in broadcast blocks of at most ``TEST_BYTES`` of text (an item is
never split); a benchmark of more takes one pass a block, each written to the
checkpoint folder. A very long document is cut into pieces for splitting and
into overlapping shards for sorting, so memory beyond its text is a few
bytes a word.

Words are runs of ASCII letters and digits and of all other non-ASCII
characters, A-Z lower-cased. Hashes of 64 bits stand for words.

Edge cases: null and empty texts have no words and hit nothing; items without
words have no window. Rows with a null or repeated document id are judged each
on their own. Items of the same id count as one; items with a null id hit
words but are not listed. Of equally long matches the first in the document
is reported, and of its items the first in table order. Empty tables give no rows or no hits. Other columns
are ignored by ``find`` and kept by ``remove``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainfold.llm import blocks as B
from chainfold.storage import write_intermediate

#: Bytes of test text broadcast at once.
TEST_BYTES = 8 << 20
#: Words of one suffix array.
SHARD_WORDS = 1 << 20

_APART = np.ones(256, bool)
_APART[ord("0") : ord("9") + 1] = False
_APART[ord("a") : ord("z") + 1] = False
_APART[128:] = False

FOUND = (
    "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>, "
    "longest struct<item:string,item_start:long,doc_start:long,n_words:long>"
)
_LONGEST = pa.struct([("item", pa.string()), ("item_start", pa.int64()), ("doc_start", pa.int64()), ("n_words", pa.int64())])
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _pieces(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Offsets with documents beyond the block size cut at bytes between words."""
    cuts = [offsets]
    for d in np.flatnonzero(np.diff(offsets) > B.BLOCK_BYTES):
        apart = np.flatnonzero(_APART[data[offsets[d] : offsets[d + 1]] | np.uint8(32)]) + offsets[d]
        at = np.searchsorted(apart, np.arange(offsets[d] + B.BLOCK_BYTES, offsets[d + 1], B.BLOCK_BYTES))
        cuts.append(np.unique(apart[at[at < len(apart)]]))
    return np.sort(np.concatenate(cuts)) if len(cuts) > 1 else offsets


def word_hashes(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, word bounds of the documents)."""
    cut = _pieces(offsets, data)
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i, j in B.spans(cut):
        words = B.split_words(cut[i : j + 1], data[cut[i] : cut[j]], lower=True, space=_APART)
        hashes.append(words.hashes)
        counts.append(np.diff(words.bounds))
    ends = np.append(0, np.cumsum(np.concatenate(counts)))
    return np.concatenate(hashes), ends[np.searchsorted(cut, offsets)] if len(cut) > len(offsets) else ends


@dataclass
class Tests:
    """A block of items as word numbers: 1 + place in ``vocabulary``, the sorted word hashes."""

    ids: list[str | None]
    vocabulary: np.ndarray
    codes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    left: np.ndarray
    need: np.ndarray
    window: np.ndarray
    least: int
    longest: int

    @classmethod
    def of(cls, ids: list[str | None], texts: list[str | None], window: int) -> Tests:
        hashes, bounds = word_hashes(*B.text_arrays(pa.array(texts, pa.string())))
        size = np.diff(bounds)
        vocabulary, codes = np.unique(hashes, return_inverse=True)
        item = np.repeat(np.arange(len(ids)), size)
        place = np.arange(len(hashes)) - bounds[item]
        left = size[item] - place
        # the window starting at each suffix: all that fit, or the whole of a short item
        length = np.where(left >= window, window, np.where(place == 0, left, 0))
        some = length[length > 0]
        least, longest = (int(some.min()), int(size.max())) if len(some) else (1, 0)
        return cls(ids, vocabulary, codes + 1, item, place, left, np.minimum(size, window)[item], length, least, longest)


def suffix_array(s: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``s`` in the order of their suffixes' first ``depth`` numbers.

    A suffix ends before ``ends`` of its place. Prefix doubling; a rank is the
    first slot of the ties, so settled suffixes are not touched again.
    """
    m = len(s)
    order = np.argsort(s.astype(np.uint16) if m and s.max() < 1 << 16 else s, kind="stable")
    slots = np.arange(m)

    def first_slots(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fresh = np.ones(len(keys), bool)
        np.not_equal(keys[1:], keys[:-1], out=fresh[1:])
        return np.maximum.accumulate(np.where(fresh, at, 0)), fresh

    start, fresh = first_slots(s[order], slots)
    rank = np.empty(m, np.int64)
    rank[order] = start
    tied = ~(fresh & np.append(fresh[1:], True))
    at, h = slots[tied], 1
    while h < depth and len(at):
        places = order[at]
        ahead = places + h
        goes_on = ahead < ends[places]
        key = rank[places] * (m + 1) + np.where(goes_on, rank[np.minimum(ahead, m - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        places, key, goes_on = places[by], key[by], goes_on[by]
        order[at] = places
        start, fresh = first_slots(key, at)
        rank[places] = start
        at = at[~(fresh & np.append(fresh[1:], True)) & goes_on]
        h *= 2
    return order


def _narrow(s, ends, order, lo, hi, depth, target):
    """Ranges of the suffix array whose number at ``depth`` is ``target``, inside ``[lo, hi)``."""
    out = []
    for side in (0, 1):
        a, b = lo.copy(), hi.copy()
        while True:
            open_ = a < b
            if not open_.any():
                break
            mid = (a + b) >> 1
            p = order[np.minimum(mid, len(order) - 1)] + depth
            at = np.minimum(p, len(s) - 1)
            value = np.where(p < ends[order[np.minimum(mid, len(order) - 1)]], s[at], 0)
            right = open_ & (value <= target if side else value < target)
            a = np.where(right, mid + 1, a)
            b = np.where(open_ & ~right, mid, b)
        out.append(a)
    return out


def _members(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(every number of the ranges ``[lo, hi)``, which range it is from)."""
    count = hi - lo
    which = np.repeat(np.arange(len(lo)), count)
    return np.arange(count.sum()) + (lo - (np.cumsum(count) - count))[which], which


def search(s: np.ndarray, ends: np.ndarray, order: np.ndarray, tests: Tests):
    """For every slot of the suffix array: longest match of a whole window or more (0 if none) and its
    first test suffix; for every test suffix: the range of its window (empty if none)."""
    n = len(tests.codes)
    lo, hi = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    best, by = np.zeros(len(order), np.int32), np.zeros(len(order), np.int32)
    window_lo, window_hi = np.zeros(n, np.int64), np.zeros(n, np.int64)
    alive = np.arange(n)
    for depth in range(tests.longest):
        alive = alive[tests.left[alive] > depth]
        if not len(alive):
            break
        a, b = _narrow(s, ends, order, lo[alive], hi[alive], depth, tests.codes[alive + depth])
        some = a < b
        alive, a, b = alive[some], a[some], b[some]
        lo[alive], hi[alive] = a, b
        whole = tests.need[alive] <= depth + 1
        if whole.any():
            # ranges of one depth are equal or apart
            low, first = np.unique(a[whole], return_index=True)
            slots, which = _members(low, b[whole][first])
            best[slots], by[slots] = depth + 1, alive[whole][first][which]
        full = alive[tests.window[alive] == depth + 1]
        window_lo[full], window_hi[full] = lo[full], hi[full]
    return best, by, window_lo, window_hi


class Hits:
    """Hits of the test items in a block of documents (word numbers counted through the block)."""

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray, tests: Tests):
        self.bounds, self.tests = bounds, tests
        n, docs = len(hashes), len(bounds) - 1
        self.covered = np.zeros(n + 1, np.int32)
        self.best = np.zeros(n, np.int32)
        self.by = np.zeros(n, np.int32)
        self.pairs: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
        if not (n and len(tests.codes)):
            return
        near = np.minimum(np.searchsorted(tests.vocabulary, hashes), len(tests.vocabulary) - 1)
        code = np.where(tests.vocabulary[near] == hashes, near + 1, 0).astype(np.int32)
        # stretches of known words inside one document
        known = code > 0
        first = known.copy()
        first[1:] &= ~known[:-1]
        edge = bounds[:-1][bounds[:-1] < n]
        first[edge] = known[edge]
        begin = np.flatnonzero(first)
        last = known.copy()
        last[:-1] &= ~known[1:] | first[1:]
        end = np.flatnonzero(last) + 1
        long = end - begin >= tests.least
        begin, size = begin[long], (end - begin)[long]
        if not len(begin):
            return
        shift = np.append(0, np.cumsum(size))
        word = np.repeat(begin - shift[:-1], size) + np.arange(shift[-1])
        ends = np.repeat(shift[1:], size)
        s = code[word]
        for a in range(0, len(s), SHARD_WORDS):
            b = min(a + SHARD_WORDS, len(s))
            c = min(b + tests.longest, len(s))
            self._shard(s[a:c], np.minimum(ends[a:c], c) - a, word[a:c], b - a)

    def _shard(self, s: np.ndarray, ends: np.ndarray, word: np.ndarray, own: int) -> None:
        tests = self.tests
        order = suffix_array(s, ends, tests.longest)
        # the overlap with the next shard belongs to that one
        order = order[order < own] if own < len(s) else order
        best, by, window_lo, window_hi = search(s, ends, order, tests)
        found = np.flatnonzero(window_lo < window_hi)
        if not len(found):
            return
        same, which = np.unique(np.stack([window_lo[found], tests.window[found]]), axis=1, return_inverse=True)
        high = np.zeros(same.shape[1], np.int64)
        high[which.ravel()] = window_hi[found]
        slots, ranges = _members(same[0], high)
        at = word[order[slots]]
        np.add.at(self.covered, at, 1)
        np.add.at(self.covered, at + same[1][ranges], -1)
        # documents of each distinct window, then the items that have it
        met = np.unique(np.stack([ranges, np.searchsorted(self.bounds, at, "right") - 1]), axis=1)
        with_item = np.unique(np.stack([which.ravel(), tests.item[found]]), axis=1)
        places, row = _members(np.searchsorted(with_item[0], met[0]), np.searchsorted(with_item[0], met[0], "right"))
        self.pairs.append(np.unique(np.stack([met[1][row], with_item[1][places]], axis=1), axis=0))
        at = word[order]
        better = best > self.best[at]
        self.best[at[better]], self.by[at[better]] = best[better], by[better]

    def rows(self) -> dict[str, pa.Array]:
        """The columns of ``FOUND``, one row per document."""
        docs, n = len(self.bounds) - 1, len(self.best)
        hit = np.cumsum(self.covered[:n]) > 0
        hits = np.append(0, np.cumsum(hit))[self.bounds]
        first, last = hit.copy(), hit.copy()
        first[1:] &= ~hit[:-1]
        last[:-1] &= ~hit[1:]
        inner = self.bounds[(self.bounds > 0) & (self.bounds < n)]
        first[inner] |= hit[inner]
        last[inner - 1] |= hit[inner - 1]
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        span_bounds = np.searchsorted(begin, self.bounds).astype(np.int32)
        origin = self.bounds[np.searchsorted(self.bounds, begin, "right") - 1]
        spans = pa.StructArray.from_arrays([pa.array(begin - origin), pa.array(end - origin)], ["start", "end"])
        pairs = np.unique(np.concatenate(self.pairs), axis=0)
        items: list[list[str]] = [[] for _ in range(docs)]
        for d, i in pairs.tolist():
            if self.tests.ids[i] is not None:
                items[d].append(self.tests.ids[i])
        longest: list[dict | None] = [None] * docs
        for d in np.flatnonzero(np.diff(hits)):
            a, b = self.bounds[d], self.bounds[d + 1]
            p = int(np.argmax(self.best[a:b]))
            j = self.by[a + p]
            longest[d] = {
                "item": self.tests.ids[self.tests.item[j]],
                "item_start": int(self.tests.place[j]),
                "doc_start": p,
                "n_words": int(self.best[a + p]),
            }
        return {
            "n_words": pa.array(np.diff(self.bounds)),
            "n_hit": pa.array(np.diff(hits)),
            "items": pa.array([sorted(set(x)) for x in items], pa.list_(pa.string())),
            "spans": pa.ListArray.from_arrays(pa.array(span_bounds), spans),
            "longest": pa.array(longest, _LONGEST),
        }


def _hits(texts: pa.Array, tests: Tests) -> Iterator[tuple[int, int, Hits]]:
    offsets, data = B.text_arrays(texts)
    for i, j in B.spans(offsets, 2 * B.BLOCK_BYTES):
        yield i, j, Hits(*word_hashes(offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]]), tests)


def _test_blocks(tests: DataFrame, item_col: str, text_col: str, window: int) -> Iterator[Tests]:
    """The items in blocks of at most TEST_BYTES of text, one at a time on the driver."""
    ids, texts, size, any_block = [], [], 0, False
    rows = tests.select(F.col(f"`{item_col}`").cast("string"), F.col(f"`{text_col}`")).where(F.col(f"`{text_col}`").isNotNull())
    for item, text in rows.toLocalIterator():
        more = len(text.encode())
        if ids and size + more > TEST_BYTES:
            yield Tests.of(ids, texts, window)
            ids, texts, size, any_block = [], [], 0, True
        ids.append(item)
        texts.append(text)
        size += more
    if ids or not any_block:
        yield Tests.of(ids, texts, window)


def _merge(old: dict, new: dict) -> dict:
    """Results of one document over two blocks of items."""
    spans: list[dict] = []
    for span in sorted(old["spans"] + new["spans"], key=lambda x: x["start"]):
        if spans and span["start"] <= spans[-1]["end"]:
            spans[-1] = {"start": spans[-1]["start"], "end": max(span["end"], spans[-1]["end"])}
        else:
            spans.append(span)
    longest = max((x for x in (old["longest"], new["longest"]) if x), key=lambda x: x["n_words"], default=None)
    return {
        "n_words": new["n_words"],
        "n_hit": sum(x["end"] - x["start"] for x in spans),
        "items": sorted(set(old["items"]) | set(new["items"])),
        "spans": spans,
        "longest": longest,
    }


def find(
    docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", window: int = 10
) -> DataFrame:
    """One row per document: ``id_col``, n_words, n_hit, items (sorted as strings), spans of hit words
    (end exclusive) and the longest match of a whole window or more (null without a hit)."""
    sc = docs.sparkSession.sparkContext
    key = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = key.schema[0].dataType.simpleString()
    state = f"`{id_col}` {kind}, {FOUND}"
    frame, fresh = key, True
    blocks = _ahead(_test_blocks(tests, item_col, text_col, window))
    for block, is_last in blocks:
        shared = sc.broadcast(block)

        def look(batches, shared=shared, fresh=fresh, is_last=is_last):
            for batch in batches:
                for i, j, hits in _hits(batch.column(1), shared.value):
                    columns = hits.rows()
                    if not fresh:
                        old = pa.Table.from_batches([batch.slice(i, j - i)]).select(list(columns)).to_pylist()
                        merged = [_merge(o, n) for o, n in zip(old, pa.table(columns).to_pylist(), strict=True)]
                        columns = {k: pa.array([m[k] for m in merged], v.type) for k, v in columns.items()}
                    own = [batch.column(0).slice(i, j - i)] + ([] if is_last else [batch.column(1).slice(i, j - i)])
                    yield pa.RecordBatch.from_arrays(
                        own + list(columns.values()), [id_col] + ([] if is_last else ["text"]) + list(columns)
                    )

        frame = frame.mapInArrow(look, state if is_last else f"`{id_col}` {kind}, text string, {FOUND}")
        if not is_last:
            frame = write_intermediate(frame, "decontaminate")
        fresh = False
    return frame


def remove(
    docs: DataFrame, tests: DataFrame, text_col: str = "text", item_col: str = "item_id", window: int = 10
) -> DataFrame:
    """The rows of ``docs`` without a hit, all columns kept."""
    sc = docs.sparkSession.sparkContext
    names, at = docs.columns, docs.columns.index(text_col)
    # by position: names may hold dots
    docs = docs.toDF(*(f"c{i}" for i in range(len(names))))
    for block, is_last in _ahead(_test_blocks(tests, item_col, text_col, window)):
        shared = sc.broadcast(block)

        def clean(batches, shared=shared):
            for batch in batches:
                for i, j, hits in _hits(batch.column(at), shared.value):
                    yield batch.slice(i, j - i).filter(pc.equal(hits.rows()["n_hit"], 0))

        docs = docs.mapInArrow(clean, docs.schema)
        if not is_last:
            docs = write_intermediate(docs, "decontaminate")
    return docs.toDF(*names)


def _ahead(blocks: Iterator[Tests]) -> Iterator[tuple[Tests, bool]]:
    """(block, whether it is the last one), with one block read ahead."""
    held = next(blocks)
    for block in blocks:
        yield held, False
        held = block
    yield held, True
