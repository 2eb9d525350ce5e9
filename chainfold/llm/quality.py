"""Quality rules: base counts, and divergence from language references.

References are learned from all documents: for each language its histogram of
character classes and its ``TOP_WORDS`` most common words with the share of
all others. A document's two histograms are compared with each reference by
Jensen-Shannon distance, so a wrong or missing language tag or a text of two
languages does no harm. A third distance takes the common words as one class
against all others: chance adds little to two classes, so it tells a short
text without common words, which the wide histogram can't. A document is
rejected unless all its distances from one reference are at most ``floor +
slack / sqrt(n_words)``; the slack is what chance alone adds to the histogram
of a short text, and under ``LEAST_JUDGED`` words the distances decide nothing
(minimum-length guard). ``class_distance`` and ``word_distance`` are the
smallest over all references.

Words are counted exactly, by hash, with partial sums in the tasks. Only the
common ones of each language reach the driver and go back to the tasks; every
language has a reference, and the time of a document grows with the number of
languages. Documents of a language without a reference (no word but marks in
all its texts) are not judged.

Edge cases: null and empty texts have no words and fail the base rules; rows
are judged one by one, so repeated ids and rows are kept or dropped alike;
null languages count for no reference; all columns of the input are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainfold.llm import blocks as B

TOP_WORDS = 64
LEAST_JUDGED = 40
WORD_FLOOR, WORD_SLACK = 0.24, 1.5
CLASS_FLOOR, CLASS_SLACK = 0.16, 0.9
SHARE_FLOOR, SHARE_SLACK = 0.06, 1.7  # the slack is four standard deviations of a share of 0.31
REPEAT_WINDOW = 8

_CLASS_ITEM, _SIZE_ITEM, _WORD_ITEM = 0, 1, 2
_CLASSES = 8
_CLASS = np.full(256, 7, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 3
_CLASS[list(b" \t\n\v\f\r")] = 2
_CLASS[list(b".,;:!?'\"()-")] = 4
_CLASS[list(b"#*$%&|<>")] = 5
_CLASS[192:] = 6
_CLASS[128:192] = _CLASSES  # the rest of a code point
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_ASCII_MARK = np.array([chr(c).isascii() and not chr(c).isalnum() for c in range(128)] + [False] * 128)


def _by_document(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def class_counts(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Code points of each class, one row per document."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    return np.bincount(owner * (_CLASSES + 1) + _CLASS[data], minlength=n * (_CLASSES + 1)).reshape(n, -1)[:, :_CLASSES]


def _dup_lines(offsets: np.ndarray, data: np.ndarray, words: B.Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their document."""
    n = len(offsets) - 1
    if not len(words.starts):
        return np.zeros(n, np.int64)
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([offsets[:-1][offsets[:-1] < len(data)], breaks[breaks + 1 < len(data)] + 1]))
    ends = np.append(starts[1:], len(data))
    ends = ends - (data[ends - 1] == 10)
    filled = ends > starts
    starts, sizes = starts[filled], (ends - starts)[filled]
    hashes = B.hash_runs(data[data != 10], np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64), sizes)
    first = np.searchsorted(words.starts, starts)
    with_word = (first < len(words.starts)) & (words.starts[np.minimum(first, len(words.starts) - 1)] < starts + sizes)
    hashes, starts = hashes[with_word], starts[with_word]
    owner = np.searchsorted(offsets, starts, "right") - 1
    order = np.lexsort((hashes, owner))
    again = (np.diff(owner[order]) == 0) & (np.diff(hashes[order].view(np.int64)) == 0)
    return np.bincount(owner[order][1:][again], minlength=n)


def _repeat_words(words: B.Words, n: int) -> np.ndarray:
    """Words inside windows of REPEAT_WINDOW words that their document holds twice or more."""
    grams = B.ngrams(words.hashes, REPEAT_WINDOW)
    if not len(grams):
        return np.zeros(n, np.int64)
    owner = np.repeat(np.arange(n), np.diff(words.bounds))
    same = owner[: len(grams)] == owner[REPEAT_WINDOW - 1 :]
    places = np.flatnonzero(same)
    with np.errstate(over="ignore"):
        keys = B.mix(grams[places] + owner[places].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    equal = np.diff(keys[order].view(np.int64)) == 0
    often = np.zeros(len(places), bool)
    often[order[1:][equal]] = True
    often[order[:-1][equal]] = True
    cover = np.zeros(len(owner) + REPEAT_WINDOW + 1, np.int64)
    cover[places[often]] += 1
    cover[places[often] + REPEAT_WINDOW] -= 1
    return np.bincount(owner[np.cumsum(cover)[: len(owner)] > 0], minlength=n)


def _distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of each row's histogram from ``reference``; 1 for an empty row."""
    total = counts.sum(1, keepdims=True)
    p = counts / np.maximum(total, 1)
    m = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        right = np.where(reference > 0, reference * np.log2(reference / m), 0).sum(1)
    return np.where(total[:, 0] > 0, np.sqrt(np.maximum(0, (left + right) / 2)), 1.0)


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> list[dict]:
    """For each language: ``classes`` (shares), ``words`` (hashes) and ``shares`` (the last one: all other words)."""

    def count(batches):
        for batch in batches:
            offsets, data = B.text_arrays(batch.column(1))
            langs = batch.column(0).dictionary_encode()
            code = langs.indices.fill_null(-1).to_numpy()
            names = langs.dictionary.to_pylist()
            found: list[tuple[str, int, np.ndarray, np.ndarray]] = []
            for i, j in B.spans(offsets):
                part, cut = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                words = B.split_words(cut, part, True)
                classes = class_counts(cut, part)
                owner = np.repeat(code[i:j], np.diff(words.bounds))
                marks = np.append(0, np.cumsum(_ASCII_MARK[words.data]))
                is_word = marks[words.ends] - marks[words.starts] < words.ends - words.starts
                for k in np.unique(code[i:j]):
                    if k < 0:
                        continue
                    own = owner == k
                    found.append((names[k], _CLASS_ITEM, np.arange(_CLASSES), classes[code[i:j] == k].sum(0)))
                    found.append((names[k], _SIZE_ITEM, np.zeros(1, np.int64), np.array([own.sum()])))
                    hashes, n = np.unique(words.hashes[own & is_word], return_counts=True)
                    found.append((names[k], _WORD_ITEM, hashes.view(np.int64), n))
            columns = [
                pa.array([f[0] for f in found], pa.string()).take(pa.array(np.repeat(np.arange(len(found)), [len(f[2]) for f in found]))),
                pa.array(np.repeat(np.array([f[1] for f in found], np.int32), [len(f[2]) for f in found])),
                *(pa.array(np.concatenate([np.zeros(0, np.int64), *(f[c] for f in found)])) for c in (2, 3)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "kind", "key", "n"])

    counts = (
        docs.select(F.col(lang_col).cast("string"), text_col)
        .mapInArrow(count, "lang string, kind int, key long, n long")
        .groupBy("lang", "kind", "key")
        .agg(F.sum("n").alias("n"))
    )
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key"))
    top = counts.withColumn("rank", rank).where(F.col("rank") <= TOP_WORDS).collect()
    out: dict[str, dict] = {}
    for row in top:
        own = out.setdefault(row["lang"], {"lang": row["lang"], "classes": np.zeros(_CLASSES), "words": {}, "size": 0})
        if row["kind"] == _WORD_ITEM:
            own["words"][row["key"]] = row["n"]
        elif row["kind"] == _SIZE_ITEM:
            own["size"] = row["n"]
        else:
            own["classes"][row["key"]] = row["n"]
    refs = []
    for own in sorted(out.values(), key=lambda r: -r["size"]):
        if own["size"] and own["words"]:
            hashes = np.array(list(own["words"]), np.int64).view(np.uint64)
            n = np.array(list(own["words"].values()), float)
            order = np.argsort(hashes)
            shares = np.append(n[order], max(0, own["size"] - n.sum())) / own["size"]
            refs.append({"lang": own["lang"], "classes": own["classes"] / own["classes"].sum(), "words": hashes[order], "shares": shares})
    return refs


MEASURES = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType())]
    + [T.StructField(c, T.DoubleType()) for c in ("class_distance", "word_distance")]
    + [T.StructField("kept", T.BooleanType())]
)


def measure_block(offsets: np.ndarray, data: np.ndarray, refs: list[dict], known: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """The fields of MEASURES for the documents of a block; ``known`` tells whose language has a reference or is null."""
    offsets = offsets - offsets[0]
    n = len(offsets) - 1
    words = B.split_words(offsets, data)
    n_words = np.diff(words.bounds)
    classes = class_counts(offsets, data)
    repeats = _repeat_words(words, n)
    failed = (n_words < 20) | (100 * repeats > 30 * n_words)
    lower = B.split_words(offsets, data, True).hashes
    owner = np.repeat(np.arange(n), n_words)
    by_class, by_word, near = np.ones(n), np.ones(n), np.zeros(n, bool)
    chance = 1 / np.sqrt(np.maximum(n_words, 1))
    for ref in refs:
        size = len(ref["words"])
        at = np.minimum(np.searchsorted(ref["words"], lower), size - 1)
        at = np.where(ref["words"][at] == lower, at, size)
        counts = np.bincount(owner * (size + 1) + at, minlength=n * (size + 1)).reshape(n, -1)
        word, of_class = _distance(counts, ref["shares"]), _distance(classes, ref["classes"])
        common = _distance(np.stack([counts[:, :-1].sum(1), counts[:, -1]], 1), np.array([1 - ref["shares"][-1], ref["shares"][-1]]))
        by_word, by_class = np.minimum(by_word, word), np.minimum(by_class, of_class)
        within = (word <= WORD_FLOOR + WORD_SLACK * chance) & (of_class <= CLASS_FLOOR + CLASS_SLACK * chance)
        near |= within & (common <= SHARE_FLOOR + SHARE_SLACK * chance)
    judged = (n_words >= LEAST_JUDGED) & bool(refs) & (True if known is None else known)
    return {
        "n_words": n_words,
        "word_chars": classes.sum(1) - classes[:, 2],
        "n_symbols": _by_document(_SYMBOL[data], offsets),
        "n_dup_lines": _dup_lines(offsets, data, words),
        "n_repeat_words": repeats,
        "base_failed": failed,
        "class_distance": by_class,
        "word_distance": by_word,
        "kept": ~failed & ~(judged & ~near),
    }


def measure(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", out_col: str = "quality") -> DataFrame:
    """``docs`` with the struct ``out_col`` of measures and the verdict; see MEASURES."""
    refs = references(docs, text_col, lang_col)
    rows = docs.drop(out_col)
    names = rows.columns
    place, lang_place = names.index(text_col), names.index(lang_col)
    has_reference = pa.array([None, *(r["lang"] for r in refs)], pa.string())

    def run(batches):
        for batch in batches:
            offsets, data = B.text_arrays(batch.column(place))
            known = np.asarray(pc.is_in(batch.column(lang_place).cast(pa.string()), has_reference))
            for i, j in B.spans(offsets):
                found = measure_block(offsets[i : j + 1], data[offsets[i] : offsets[j]], refs, known[i:j])
                struct = pa.StructArray.from_arrays([pa.array(v) for v in found.values()], list(found))
                yield pa.RecordBatch.from_arrays([batch.column(k).slice(i, j - i) for k in range(len(names))] + [struct], [*names, out_col])

    return rows.mapInArrow(run, B.with_field(rows.schema, out_col, MEASURES))


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass."""
    return measure(docs, text_col, lang_col, "__quality").where("__quality.kept").select(*docs.columns)
