"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained in numpy.

A word is the bag of its byte n-grams (3 to 6, with word marks) and of
itself, each hashed to one of ``BUCKETS`` embedding rows. The vector of a word
is the mean of its rows, the vector of a text the mean over its words, and a
linear softmax gives the class. Rows and softmax are trained jointly, so a
misspelling that was never seen still lies near the words whose n-grams it
shares.

Training takes a bounded sample of labelled rows: at most ``SAMPLE_PER_CLASS``
texts of each class in the order of a hash of the id, each of at most
``SAMPLE_BYTES``. It is what reaches the driver. Scoring runs over all whole
texts, in tasks without a shuffle; the model goes to them as one number per
bucket. Classes are weighted to balance in training and the prior is put
back afterwards, so a score is a probability.

Edge cases: null and empty texts get the prior; with no labelled text, or of
one class only, every score is the share of label 1 (0 without labels). Rows
that repeat an id are scored one by one. Null labels are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainfold.llm import blocks as B
from chainfold.storage import write_intermediate

BUCKETS = 1 << 16
DIMENSION = 8
GRAMS = (3, 4, 5, 6)
SCALE = 100.0
SAMPLE_PER_CLASS = 2000
SAMPLE_BYTES = 16 << 10
EPOCHS = 20
BATCH = 32
RATE = 0.15
DECAY = 1e-4
THRESHOLD = 0.3


@dataclass
class Model:
    """Log-odds of a text: ``bias`` plus the mean over its words of the mean of ``weight`` over the word's buckets."""

    weight: np.ndarray
    bias: float
    prior: float


def word_buckets(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every n-gram of every word."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) + 2
    if not len(pieces):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(b"".join(b"\x02" + p + b"\x03" for p in pieces), np.uint8)
    at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    owner = np.repeat(np.arange(len(pieces)), sizes)
    words, hashes = [np.arange(len(pieces))], [B.hash_runs(data, at, sizes)]
    codes = B._BYTE[data]
    for n in GRAMS:
        if len(data) >= n:
            fits = np.flatnonzero(owner[: len(data) - n + 1] == owner[n - 1 :])
            words.append(owner[fits])
            hashes.append(B.ngrams(codes, n)[fits])
    return np.concatenate(words), (np.concatenate(hashes) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _distinct_words(words: B.Words) -> tuple[list[bytes], np.ndarray]:
    _, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
    raw = words.data.tobytes()
    return [raw[s:e] for s, e in zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)], which


def train(texts: pa.Array, labels: np.ndarray, prior: float) -> Model:
    """Fit on texts with labels 0 and 1; ``prior`` is the share of label 1 to be restored."""
    if len(labels) == 0 or labels.min() == labels.max():
        return Model(np.zeros(BUCKETS), _logit(prior), prior)
    offsets, data = B.text_arrays(texts)
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    for i, j in B.spans(offsets):
        words = B.split_words(offsets[i : j + 1], data[offsets[i] : offsets[j]], True)
        pieces, which = _distinct_words(words)
        owner, bucket = word_buckets(pieces)
        share = 1 / np.bincount(owner, minlength=max(1, len(pieces)))
        order = np.argsort(owner, kind="stable")
        first = np.searchsorted(owner[order], np.arange(len(pieces) + 1))
        for d in range(j - i):
            own, n = np.unique(which[words.bounds[d] : words.bounds[d + 1]], return_counts=True)
            if not len(own):
                rows.append((np.zeros(0, np.int32), np.zeros(0, np.float32)))
                continue
            parts = np.concatenate([order[first[w] : first[w + 1]] for w in own.tolist()])
            weight = np.repeat(n * share[own], first[own + 1] - first[own]) / n.sum()
            sums = np.bincount(bucket[parts], weights=weight, minlength=BUCKETS)
            at = np.flatnonzero(sums)
            rows.append((at.astype(np.int32), (SCALE * sums[at]).astype(np.float32)))
    rng = np.random.default_rng(7)
    table = (rng.standard_normal((BUCKETS, DIMENSION)) * 0.1).astype(np.float32)
    soft = (rng.standard_normal((DIMENSION, 2)) * 0.1).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen = [np.full(x.shape, 1e-3, np.float32) for x in (table, soft, bias)]
    balance = len(labels) / (2 * np.bincount(labels, minlength=2))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(rows))
        for s in range(0, len(order), BATCH):
            take = order[s : s + BATCH]
            at = np.concatenate([rows[k][0] for k in take])
            x = np.concatenate([rows[k][1] for k in take])
            owner = np.repeat(np.arange(len(take)), [len(rows[k][0]) for k in take])
            rows_x = table[at] * x[:, None]
            text = np.stack([np.bincount(owner, weights=rows_x[:, c], minlength=len(take)) for c in range(DIMENSION)], 1)
            z = text @ soft + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(take)), labels[take]] -= 1
            p *= (balance[labels[take]] / len(take))[:, None]
            back = p @ soft.T
            used, place = np.unique(at, return_inverse=True)
            step = np.stack([np.bincount(place, weights=back[owner, c] * x, minlength=len(used)) for c in range(DIMENSION)], 1)
            step += DECAY * table[used]
            seen[0][used] += step**2
            table[used] -= rate * step / np.sqrt(seen[0][used])
            for value, total, grad in ((soft, seen[1], text.T @ p), (bias, seen[2], p.sum(0))):
                total += grad**2
                value -= rate * grad / np.sqrt(total)
    weight = SCALE * (table @ (soft[:, 1] - soft[:, 0])).astype(np.float64)
    return Model(weight, float(bias[1] - bias[0]) + _logit(prior), prior)


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))


def score_block(model: Model, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Probability of label 1 of each document of a block."""
    words = B.split_words(offsets, data, True)
    pieces, which = _distinct_words(words)
    owner, bucket = word_buckets(pieces)
    n = np.maximum(1, np.bincount(owner, minlength=len(pieces)))
    by_word = np.bincount(owner, weights=model.weight[bucket], minlength=len(pieces)) / n
    total = np.concatenate([[0], np.cumsum(by_word[which])])
    sums = total[words.bounds[1:]] - total[words.bounds[:-1]]
    counts = np.diff(words.bounds)
    z = model.bias + sums / np.maximum(counts, 1)
    return np.where(counts > 0, 1 / (1 + np.exp(-np.clip(z, -50, 50))), model.prior)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Train on the labelled rows for which ``learn`` (over the id) holds."""
    known = labels.where(learn).where(F.col(label_col).isin(0, 1)).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"))
    shares = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = shares.get(1, 0) / max(1, sum(shares.values()))
    picked = [known.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(2 * SAMPLE_PER_CLASS) for k in (0, 1)]
    # at most 4 * SAMPLE_PER_CLASS ids, so the documents need no shuffle
    wanted = F.broadcast(picked[0].unionByName(picked[1]))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.octet_length("text") <= SAMPLE_BYTES)
    # of the rows of one id: label 1 before 0, then one text in a fixed order, so that equal tables give one model
    one = F.max(F.struct("label", F.xxhash64("text").alias("hash"), "text")).alias("one")
    found = write_intermediate(texts.join(wanted, "id").groupBy("id").agg(one).select("id", "one.label", "one.text"), "toxicity-sample")
    parts = [found.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_PER_CLASS).toArrow() for k in (0, 1)]
    sample = pa.concat_tables(parts)
    return train(sample["text"].combine_chunks(), sample["label"].to_numpy().astype(np.int64), prior)


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with ``out_col``, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias, model.prior))
    rows = docs.drop(out_col)
    names = rows.columns
    place = names.index(text_col)

    def run(batches):
        own = Model(*shared.value)
        for batch in batches:
            offsets, data = B.text_arrays(batch.column(place))
            for i, j in B.spans(offsets, 4 * B.BLOCK_BYTES):
                found = score_block(own, offsets[i : j + 1], data[offsets[i] : offsets[j]])
                yield pa.RecordBatch.from_arrays([batch.column(k).slice(i, j - i) for k in range(len(names))] + [pa.array(found)], [*names, out_col])

    return rows.mapInArrow(run, B.with_field(rows.schema, out_col, T.DoubleType()))
