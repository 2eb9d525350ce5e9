from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from chainfold.llm import blocks as B
from chainfold.llm import quality as Q
from tests.conftest import CHECK_DIR

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    places = {}
    for p in range(len(w) - 7):
        places.setdefault(tuple(w[p : p + 8]), []).append(p)
    cover = {q for v in places.values() if len(v) > 1 for p in v for q in range(p, p + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover), len(w) < 20 or 100 * len(cover) > 30 * len(w)


def distance(p, q):
    m = (p + q) / 2
    part = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m, strict=True) if x)
    return np.sqrt(max(0, (part(p) + part(q)) / 2))


def test_base_counts(spark):
    rnd = random.Random(1)
    texts = [None, "", " \n\n a\na\n a\na\n\n", "x\r\nx\r\nx", "a b c d e f g h " * 3, "word " * 30_000]
    texts += ["".join(rnd.choice("ab \n#é|\t") for _ in range(rnd.randint(0, 80))) for _ in range(800)]
    docs = spark.createDataFrame([(i, t, "en", "clash") for i, t in enumerate(texts)], "doc_id long, text string, lang string, quality string")
    got = {r["doc_id"]: r["quality"] for r in Q.measure(docs.repartition(4)).collect()}
    for i, t in enumerate(texts):
        assert tuple(got[i])[:6] == base(t), repr(t)[:80]
        assert not (got[i]["base_failed"] and got[i]["kept"])


def test_distances_against_a_plain_version(spark):
    docs = pq.read_table(f"{CHECK_DIR}/documents.parquet").to_pylist()
    frame = spark.read.parquet(f"{CHECK_DIR}/documents.parquet")
    refs = Q.references(frame)
    assert len(refs) == 4
    got = {r["doc_id"]: r["quality"] for r in Q.measure(frame).collect()}
    for row in docs[::25]:
        words = WORD.findall(row["text"].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        hashes = [int(B.hash_runs(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w.encode())]))[0]) for w in words]
        offsets, data = B.text_arrays(pa.array([row["text"]]))
        classes = Q.class_counts(offsets, data)[0]
        best = [1.0, 1.0]
        for ref in refs:
            place = {int(h): k for k, h in enumerate(ref["words"])}
            counts = np.bincount([place.get(h, len(place)) for h in hashes], minlength=len(place) + 1)
            best = [min(best[0], distance(classes / classes.sum(), ref["classes"])), min(best[1], distance(counts / counts.sum(), ref["shares"]))]
        q = got[row["doc_id"]]
        assert q["class_distance"] == pytest.approx(best[0], abs=1e-9) and q["word_distance"] == pytest.approx(best[1], abs=1e-9)


def test_reference_counts_are_exact(spark):
    frame = spark.read.parquet(f"{CHECK_DIR}/documents.parquet")
    rows = [(r["lang"], r["text"]) for r in frame.collect()]
    for ref in Q.references(frame.repartition(13)):
        words = [w for lang, t in rows if lang == ref["lang"] for w in WORD.findall(t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))]
        counts = Counter(w for w in words if not (w.isascii() and not any(c.isalnum() for c in w)))
        common = sorted(counts.values(), reverse=True)[: Q.TOP_WORDS]
        assert sorted(ref["shares"][:-1], reverse=True) == pytest.approx([n / len(words) for n in common], abs=1e-12)
        assert ref["shares"].sum() == pytest.approx(1)


@pytest.mark.parametrize("n", [50, 400])
def test_a_language_without_common_words_stays(spark, n):
    """One "word" a clause, none of them common: more documents don't lose the language its reference."""
    rnd = random.Random(5)
    english = [w for w in "the of and a in to it is was that for on are with as at be this have from".split()]
    signs = [chr(c) for c in range(0x4E00, 0x4E00 + 600)]
    clause = lambda: "".join(rnd.choice(signs) for _ in range(rnd.randint(6, 12))) + "，"
    rows = [(i, " ".join(clause() for _ in range(60)), "zh") for i in range(n)]
    rows += [(10_000 + i, " ".join(rnd.choice(english) for _ in range(120)), "en") for i in range(60)]
    rows += [(20_000, " ".join("-" * rnd.randint(1, 9) for _ in range(200)) + " ??", "marks")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in Q.keep_good(docs.repartition(3)).select("doc_id").collect()}
    assert {i for i, _, lang in rows if lang == "zh"} <= kept
    assert kept == {r["doc_id"] for r in Q.keep_good(docs.coalesce(1)).select("doc_id").collect()}


def test_clean_documents_stay_and_junk_goes(spark):
    frame = spark.read.parquet(f"{CHECK_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{CHECK_DIR}/labels.parquet")
    rows = Q.measure(frame).select("doc_id", "quality.kept", "quality.base_failed").join(labels, "doc_id").collect()
    clean = [r for r in rows if r["quality"] == 1 and not r["base_failed"]]
    junk = [r for r in rows if r["quality"] == 0]
    assert all(r["kept"] for r in clean)
    assert sum(not r["kept"] for r in junk) >= 0.85 * len(junk)


def test_empty_table_and_filter(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert Q.measure(docs).collect() == [] and Q.keep_good(docs).columns == ["doc_id", "text", "lang"]
    rows = [(1, " ".join(f"w{i}" for i in range(30)), None), (1, "short", None), (None, None, None)]
    kept = Q.keep_good(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert [r["doc_id"] for r in kept] == [1]


def test_every_language_has_a_reference(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(70):
        vocab = [f"{chr(97 + k % 26)}{'aeiou'[k // 26]}{rnd.choice('lmnrst')}{i}" for i in range(40)]
        rows += [(k * 10 + j, " ".join(rnd.choice(vocab) for _ in range(200 - k)), f"l{k}") for j in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(Q.references(docs)) == 70
    assert {r["doc_id"] for r in Q.keep_good(docs).select("doc_id").collect()} == {r[0] for r in rows}


def test_short_texts_without_common_words_go(spark):
    refs = Q.references(spark.read.parquet(f"{CHECK_DIR}/documents.parquet"))
    rnd = random.Random(4)
    texts = [" ".join("".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(6, 9))) for _ in range(n)) for n in range(40, 80)]
    found = Q.measure_block(*B.text_arrays(pa.array(texts)), refs)
    assert not found["base_failed"].any() and not found["kept"].any()


def test_one_reference_vouches_for_words_and_classes():
    def ref(words, shares, classes):
        hashes = np.array([B.hash_runs(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)]))[0] for w in words])
        order = np.argsort(hashes)
        return {"words": hashes[order], "shares": np.append(np.array(shares)[order], 1 - sum(shares)), "classes": np.array(classes, float)}

    rnd = random.Random(6)
    text = " ".join(rnd.choice(["ab", "cd", "ef", "gh"]) for _ in range(400))
    offsets, data = B.text_arrays(pa.array([text]))
    own = Q.class_counts(offsets, data)[0] / len(text)
    upper = own[[1, 0, 2, 3, 4, 5, 6, 7]]
    words, shares = ["ab", "cd", "ef", "gh"], [0.25, 0.25, 0.25, 0.24]
    split = [ref(words, shares, upper), ref(["zz", "yy"], [0.3, 0.2], own)]
    assert Q.measure_block(offsets, data, [ref(words, shares, own)])["kept"].tolist() == [True]
    assert Q.measure_block(offsets, data, split)["kept"].tolist() == [False]
