"""Exact top-k search: BM25 over sharded inverted indexes with block-max pruning.

A shard is a run of documents of one task. Its index, one row of a written
table, holds sorted term hashes, postings by (term, document) with term
counts, and document lengths. Document numbers, average length and document
frequencies are summed over all shards, so every shard scores with the same
global statistics.

Queries with the same terms are one set, asked once; its result is joined
back to their ids. Sets run in blocks of about ``BLOCK_TERMS`` terms, dealt by
hash; a block is sent to all shards. In a shard, terms in one of
``COMMON_SHARE`` documents or more are the common lists; they are cut at
document blocks of ``DOC_BLOCK``, each with its largest weight, and one matrix
product bounds all blocks for ``QUERY_BATCH`` queries. A query walks the lists
of its rare terms only, and a document's upper bound is what those gave it plus
its block's. Documents whose bound reaches the floor are pivots: their common
terms are summed from rounded weights, and those still near the ``k``-th best
are scored in full. The floor is the ``k``-th best score so far: about one of
``SEED_SHARE`` shards goes first and sets it for the others; without one, the
``FIRST_DOCS`` documents of the largest bounds set it. Rounded sums are widened
by more than their error and nothing below the floor is ever in the result, so
pruning is exact. The shards' top k are merged by (score descending, id
ascending).

BM25 with ``k1`` and ``b``; idf is ``ln(1 + (N - df + 0.5) / (df + 0.5))``; a
query is its set of distinct terms, words lower-cased over A-Z. Sums run in
the order of the term hashes in every shard, whichever lists are common there,
so equal texts score equal. Documents without a common term are no result.

Edge cases: null and empty texts match nothing and ask nothing; null ids are
not indexed and not asked; rows that repeat an id are separate documents, and
a repeated query id is asked once per different text and its results merged.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainfold.llm import blocks as B
from chainfold.storage import write_intermediate

K1, LENGTH_B = 1.2, 0.75
SHARD_BYTES = 32 << 20
DOC_BLOCK = 4
COMMON_SHARE = 16
COMMON_BYTES = 32 << 20
FIRST_DOCS = 64
NEAR_DOCS = 1024
QUERY_BATCH = 64
WEIGH_POSTINGS = 1 << 18
BATCH_BYTES = 4 << 20
SEED_SHARE = 16
BLOCK_TERMS = 1_000_000
_SHARD = ("ids", "lengths", "terms", "offsets", "docs", "counts")
_INDEX = "shard long, seed int, n_docs long, n_words long, ids binary, lengths binary, terms binary, offsets binary, docs binary, counts binary"


def _shard(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(lengths, terms, offsets, docs, counts) of the documents."""
    docs, counts, hashes, lengths = [], [], [], []
    for i, j in B.spans(offsets):
        words = B.split_words(offsets[i : j + 1], data[offsets[i] : offsets[j]], True)
        size = np.diff(words.bounds)
        owner = np.repeat(np.arange(i, j, dtype=np.int32), size)
        order = np.lexsort((owner, words.hashes))
        h, d = words.hashes[order], owner[order]
        new = np.append(True, (np.diff(h.view(np.int64)) != 0) | (np.diff(d) != 0))[: len(h)]
        at = np.flatnonzero(new)
        docs.append(d[at])
        counts.append(np.diff(np.append(at, len(h))).astype(np.int32))
        hashes.append(h[at])
        lengths.append(size)
    h, hashes = np.concatenate(hashes), None
    order = np.argsort(h, kind="stable")
    h = h[order]
    first = np.flatnonzero(np.append(True, np.diff(h.view(np.int64)) != 0)[: len(h)])
    terms, offsets, h = h[first], np.append(first, len(h)), None
    docs, counts = (np.concatenate(c)[order] for c in (docs, counts))
    return np.concatenate(lengths), terms, offsets, docs, counts


def _narrow(values: np.ndarray) -> np.ndarray:
    """Numbers from 0 on in 1, 2 or 4 bytes each."""
    most = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.int32)


def _widen(data, n: int) -> np.ndarray:
    """``n`` numbers of a cell written from ``_narrow``."""
    values = np.frombuffer(data, np.uint8)
    return values.view((np.uint8, np.uint16, np.int32)[len(values) // n // 2]) if n else values.view(np.int32)


def _cell(values: np.ndarray) -> pa.Array:
    """The bytes of an array as the only row of a binary column, not copied."""
    return pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, values.nbytes], np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per shard; see the module text."""

    def run(batches):
        for batch in batches:
            offsets, data = B.text_arrays(batch.column(1))
            ids = batch.column(0).to_numpy()
            # shards of about the same size, instead of full ones and a rest
            parts = max(1, -(-int(offsets[-1]) // SHARD_BYTES))
            for i, j in B.spans(offsets, int(offsets[-1] / parts * 1.02) + 1):
                own = offsets[i : j + 1] - offsets[i]
                if own[-1] == 0:
                    continue
                lengths, terms, at, places, counts = _shard(own, data[offsets[i] : offsets[j]])
                row = [int(ids[i]), int(B.mix(ids[i : i + 1])[0] % np.uint64(SEED_SHARE) == 0), j - i, int(lengths.sum())]
                cells = [ids[i:j], lengths.astype(np.int32), terms, at.astype(np.int64), _narrow(places), _narrow(counts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(row, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)] + [_cell(c) for c in cells],
                    ["shard", "seed", "n_docs", "n_words", "ids", "lengths", "terms", "offsets", "docs", "counts"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    return write_intermediate(rows.mapInArrow(run, _INDEX), "search-index")


def _query_terms(queries: DataFrame) -> DataFrame:
    """query_id, terms (sorted distinct hashes) of every query with a word."""

    def run(batches):
        for batch in batches:
            offsets, data = B.text_arrays(batch.column(1))
            ids, terms = [], []
            for i, j in B.spans(offsets):
                words = B.split_words(offsets[i : j + 1], data[offsets[i] : offsets[j]], True)
                for k in range(j - i):
                    own = np.unique(words.hashes[words.bounds[k] : words.bounds[k + 1]])
                    if len(own):
                        ids.append(batch.column(0)[i + k].as_py())
                        terms.append(own)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), B.long_array(terms)], ["query_id", "terms"])

    return queries.mapInArrow(run, "query_id long, terms array<long>")


def _document_frequency(index: DataFrame) -> DataFrame:
    """term, df over all shards."""

    def run(batches):
        for batch in batches:
            for terms, offsets in zip(batch.column(0), batch.column(1), strict=True):
                term = np.frombuffer(terms.as_buffer(), np.int64)
                df = np.diff(np.frombuffer(offsets.as_buffer(), np.int64))
                for i in range(0, len(term), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(term[i : i + 100_000]), pa.array(df[i : i + 100_000])], ["term", "df"])

    return index.select("terms", "offsets").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Shard:
    """A shard's index with weights and block maxima, ready for queries."""

    def __init__(self, row: dict, mean_length: float):
        self.ids = np.frombuffer(row["ids"], np.int64)
        lengths = np.frombuffer(row["lengths"], np.int32)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.offsets = np.frombuffer(row["offsets"], np.int64)
        self.docs, self.counts = (_widen(row[c], int(self.offsets[-1])) for c in ("docs", "counts"))
        counts = self.counts
        self.norm = K1 * (1 - LENGTH_B + LENGTH_B * lengths / mean_length)
        n = len(self.ids)
        self.size = np.diff(self.offsets)
        common = np.flatnonzero(self.size * COMMON_SHARE >= n)
        most = max(1, COMMON_BYTES // (n * (counts.itemsize + 4)))
        if len(common) > most:
            common = np.sort(common[np.argsort(-self.size[common], kind="stable")[:most]])
        self.row_of = np.full(len(self.terms), -1)
        self.row_of[common] = np.arange(len(common))
        self.n_blocks = -(-n // DOC_BLOCK)
        self.block_top = np.zeros((len(common), self.n_blocks), np.float32)
        often = np.zeros((len(common), n), counts.dtype)
        rounded = np.zeros((len(common), n), np.float32)
        for k, t in enumerate(common.tolist()):
            a, b = self.offsets[t], self.offsets[t + 1]
            docs = self.docs[a:b]
            weights = self._weight(counts[a:b], docs)
            often[k, docs], rounded[k, docs] = counts[a:b], weights
            block = docs // DOC_BLOCK
            new = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            self.block_top[k, block[new]] = np.maximum.reduceat(weights, new)
        # by document: its counts and rounded weights of the common terms
        self.often, often = np.ascontiguousarray(often.T), None
        self.rounded = np.ascontiguousarray(rounded.T)

    def _weight(self, counts: np.ndarray, docs: np.ndarray) -> np.ndarray:
        return counts * (K1 + 1) / (counts + self.norm[docs])

    @property
    def weights(self) -> np.ndarray:
        """Of all postings, without idf."""
        return self._weight(self.counts, self.docs)

    def weigh(self, terms: np.ndarray, idf: np.ndarray) -> None:
        """Take up the terms that queries name by place: list, row if common, idf; and what each posting adds, rounded, next to its document."""
        # a term is one row, so one reach into memory; a term that is not there has no postings
        self.lists = np.zeros((len(terms), 4), np.int64)
        self.lists[:, 2] = -1
        self.lists[:, 3] = idf.astype(np.float64).view(np.int64)
        by_term = np.zeros(len(self.terms))
        for i in range(0, len(terms) if len(self.terms) else 0, WEIGH_POSTINGS):
            part = terms[i : i + WEIGH_POSTINGS]
            at = np.minimum(np.searchsorted(self.terms, part), len(self.terms) - 1)
            here = np.flatnonzero(self.terms[at] == part)
            at, here = at[here], here + i
            self.lists[here, 0], self.lists[here, 1], self.lists[here, 2] = self.offsets[at], self.size[at], self.row_of[at]
            by_term[at] = idf[here]
        self.postings = np.empty(len(self.docs), "<i8")
        for a, b in B.spans(self.offsets, WEIGH_POSTINGS):
            own = slice(self.offsets[a], self.offsets[b])
            added = self._weight(self.counts[own], self.docs[own]) * np.repeat(by_term[a:b], self.size[a:b])
            self.postings[own] = self.docs[own].astype("<i8") << 32 | added.astype("<f4").view("<u4")

    def top(self, terms: np.ndarray, idf: np.ndarray, k: int, floor: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best ``k`` documents from ``floor`` on, ties by id."""
        self.weigh(terms, idf)
        return next(self.tops(np.arange(len(terms)), np.array([len(terms)]), [floor], k))

    def tops(self, places: np.ndarray, ends: np.ndarray, floors: Sequence[float], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for each query: its terms' places among those weighed are ``places`` up to its end."""
        n_common = len(self.block_top)
        step = max(1, min(QUERY_BATCH, BATCH_BYTES // (4 * (n_common + self.n_blocks))))
        first = 0
        for i in range(0, len(ends), step):
            cut = ends[i : i + step]
            lists = self.lists.take(places[first : cut[-1]], axis=0)
            row, idf = lists[:, 2], lists[:, 3].copy().view(np.float64)
            slot = np.repeat(np.arange(len(cut)), np.diff(cut, prepend=first))
            asked = np.zeros((len(cut), n_common), np.float32)
            often = row >= 0
            asked[slot[often], row[often]] = idf[often]
            bounds = asked @ self.block_top
            at = np.append(0, cut - first)
            for j in range(len(cut)):
                own = slice(at[j], at[j + 1])
                yield self._best(lists[own], idf[own], asked[j], bounds[j], floors[i + j], k)
            first = cut[-1]

    def _best(self, lists: np.ndarray, idf: np.ndarray, asked: np.ndarray, block_bound: np.ndarray, floor: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        row = lists[:, 2]
        is_rare = row < 0
        often = row[~is_rare]
        starts, size = lists[is_rare, 0], lists[is_rare, 1]
        places = _ranges(starts, size)
        postings = self.postings.take(places, mode="clip")
        owners = postings >> 32
        partial = np.bincount(owners, weights=postings.view("<f4")[::2], minlength=self.n_blocks * DOC_BLOCK)
        # sums of rounded numbers are within this share of the exact ones
        slack = 2e-7 * (len(often) + 8)
        bound = (partial + np.repeat(block_bound, DOC_BLOCK))[: len(self.ids)]
        docs = np.flatnonzero(bound >= floor * (1 - slack) if floor > 0 else bound > 0)

        def near(docs: np.ndarray) -> np.ndarray:
            return partial[docs] + np.concatenate([self.rounded.take(docs[i : i + NEAR_DOCS], axis=0) @ asked for i in range(0, len(docs), NEAR_DOCS)])

        def raised(scores: np.ndarray) -> float:
            return max(floor, np.partition(scores, len(scores) - k)[len(scores) - k] * (1 - slack)) if len(scores) >= k else floor

        if len(docs) > FIRST_DOCS:
            reach = bound[docs]
            floor = raised(near(docs[np.argpartition(-reach, FIRST_DOCS)[:FIRST_DOCS]]))
            docs = docs[reach >= floor * (1 - slack)]
        self.scored += len(docs)
        if len(docs):
            scores = near(docs)
            docs = docs[scores >= raised(scores) * (1 - slack)]
        if not len(docs):
            return self.ids[:0], np.zeros(0)
        kept = np.zeros(len(self.ids), bool)
        kept[docs] = True
        hits = np.flatnonzero(kept.take(owners, mode="clip"))
        term = np.flatnonzero(is_rare)[np.searchsorted(np.cumsum(size), hits, "right")]
        values = np.zeros((len(idf), len(docs)))
        values[term, np.searchsorted(docs, owners[hits])] = self._weight(self.counts[places[hits]], owners[hits]) * idf[term]
        values[~is_rare] = self._weight(self.often[docs, often[:, None]], docs) * idf[~is_rare][:, None]
        # bincount adds in the order given: by term, whichever list it came from
        scores = np.bincount(np.tile(np.arange(len(docs)), len(idf)), weights=values.ravel(), minlength=len(docs))
        docs, scores = docs[scores > 0], scores[scores > 0]
        ids = self.ids[docs]
        best = np.lexsort((ids, -scores))[:k]
        return ids[best], scores[best]

    scored = 0


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after another."""
    total = np.cumsum(sizes)
    return np.repeat(starts - (total - sizes), sizes) + np.arange(total[-1] if len(total) else 0)


def top_k(index: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """query_id, doc_id, score, rank of the best ``k`` documents of every query."""
    stats = index.agg(F.sum("n_docs").alias("n"), F.sum("n_words").alias("words"), F.count(F.lit(1)).alias("shards")).first()
    asked = queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(text_col).alias("text")).where("query_id is not null")
    keyed = write_intermediate(_query_terms(asked).withColumn("key", F.xxhash64("terms")), "search-queries")
    ids = keyed.select("query_id", "key").distinct()
    terms = write_intermediate(keyed.select("key", "terms").distinct(), "search-sets")
    frequency = _document_frequency(index).join(terms.select(F.explode("terms").alias("term")).distinct(), "term")
    frequency = write_intermediate(frequency, "search-frequency")
    idf = F.log(1 + (float(stats["n"] or 0) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    size = terms.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = max(1, -(-size // BLOCK_TERMS))
    weighted = terms.select("key", F.posexplode("terms").alias("at", "term")).join(frequency, "term")
    weighted = weighted.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "term", idf.alias("idf")))).alias("t"))
    weighted = weighted.select(
        "key", F.pmod("key", F.lit(n_blocks)).alias("block"), F.transform("t", lambda t: t.getField("term")).alias("terms"), F.transform("t", lambda t: t.getField("idf")).alias("idf")
    )
    weighted = write_intermediate(weighted, "search-weighted")
    mean_length = (stats["words"] or 0) / max(1, stats["n"] or 0)
    found = None
    for block in range(n_blocks):
        part = _search_block(index, weighted.where(F.col("block") == block), mean_length, k, stats["shards"] >= 2 * SEED_SHARE)
        found = part if found is None else found.unionByName(part)
    best = found.groupBy("key", "doc_id").agg(F.max("score").alias("score"))
    of_set = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "doc_id"))
    best = best.withColumn("rank", of_set).where(F.col("rank") <= k).join(ids, "key")
    best = best.groupBy("query_id", "doc_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k)


def _search_block(index: DataFrame, block: DataFrame, mean_length: float, k: int, seeded: bool) -> DataFrame:
    """key, doc_id, score of the best documents of every shard.

    If ``seeded``, about one of ``SEED_SHARE`` shards goes first; the ``k``-th
    best id of a query there is the floor its scores must reach in the others.
    """
    asked = block.select("key", "terms", "idf").toArrow().combine_chunks()
    keys = asked["key"].to_numpy()
    lists = pa.concat_arrays(asked["terms"].chunks) if len(keys) else pa.array([], pa.list_(pa.int64()))
    terms, first, places = np.unique(lists.flatten().to_numpy().view(np.uint64), return_index=True, return_inverse=True)
    idf = np.concatenate([np.zeros(0), *(c.flatten().to_numpy() for c in asked["idf"].chunks)])[first]
    ends = np.cumsum(lists.value_lengths().to_numpy().astype(np.int64))
    sets = index.sparkSession.sparkContext.broadcast((keys, terms, idf, places.astype(np.int32), ends))

    def search(shards: DataFrame, floors: np.ndarray) -> DataFrame:
        shared = index.sparkSession.sparkContext.broadcast(floors)

        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    shard = Shard({c: batch.column(c)[i].as_buffer() for c in _SHARD}, mean_length)
                    keys, terms, idf, places, ends = sets.value
                    shard.weigh(terms, idf)
                    found = list(shard.tops(places, ends, shared.value, k))
                    if found:
                        who = np.repeat(keys, [len(ids) for ids, _ in found])
                        columns = (who, *(np.concatenate([f[c] for f in found]) for c in (0, 1)))
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "doc_id", "score"])

        found = write_intermediate(shards.select(*_SHARD).mapInArrow(run, "key long, doc_id long, score double"), "search-found")
        shared.destroy()
        return found

    floors = np.zeros(len(keys))
    if not seeded:
        found = search(index, floors)
        sets.destroy()
        return found
    seeds = search(index.where(F.col("seed") == 1), floors)
    order = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score")))
    last = seeds.groupBy("key", "doc_id").agg(F.max("score").alias("score")).withColumn("rank", order).where(F.col("rank") == k)
    last = last.select("key", "score").toArrow()
    at = np.argsort(keys)
    floors[at[np.searchsorted(keys[at], last["key"].to_numpy())]] = last["score"].to_numpy()
    others = search(index.where(F.col("seed") == 0), floors)
    sets.destroy()
    return seeds.unionByName(others)
