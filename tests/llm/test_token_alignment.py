from __future__ import annotations

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from chainfold.llm import token_alignment as T
from tests.conftest import SMOKE_DIR

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in shown)}

    def side_a(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids
        return ids, [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids]

    def side_b(text):
        ids = b.encode(text)
        pieces = [b.id_to_piece(i) for i in ids]
        return ids, [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, pieces, strict=True)]

    return side_a, side_b


def brute(rows):
    side_a, side_b = libraries()
    per_doc, counts = [], Counter()
    for doc, text in rows:
        (a, ta), (b, tb) = (side_a(text), side_b(text)) if text else (([], []), ([], []))
        if not text or b"".join(ta) != (" " + text).encode() or b"".join(tb) != (" " + text).encode():
            a, ta, b, tb = [], [], [], []
        ends_a, ends_b = np.cumsum([len(t) for t in ta]), np.cumsum([len(t) for t in tb])
        links = [(a[i], b[j]) for j, e in enumerate(ends_b) for i in np.flatnonzero(ends_a == e)] if a else []
        counts.update(links)
        cuts = sorted(set(ends_a) & set(ends_b)) if a else []
        groups, low = [], 0
        for cut in cuts:
            part = [",".join(str(x) for x, e in zip(ids, ends, strict=True) if low < e <= cut) for ids, ends in ((a, ends_a), (b, ends_b))]
            groups.append("|".join(part))
            low = cut
        per_doc.append((doc, len(a), len(b), len(cuts), links, ";".join(groups)))
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return sorted(
        ((d, na, nb, ng, len(ls), sum(counts[x] == top[x[1]] for x in ls), sum(counts[x] for x in ls), g) for d, na, nb, ng, ls, g in per_doc), key=repr
    )


def texts(spark):
    rnd = random.Random(4)
    docs = [r["text"] for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    odd = ["<|endoftext|> </s><s>[INST] <0x41>", "a▁b", "▁", " ", "   x", "\n\n\t z \n", "naïve — 日本語 🙂👩‍👩‍👧", "é̀ ­", "\x00 a", "don't 'S", "!" * 90]
    alphabet = [" ", "  ", "\n", "a", "é", "日", "'s", "▁", "9", "😀", "​", "<0x0A>", "Hello", "ing"]
    odd += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 40))) for _ in range(60)]
    return docs[:60], odd


def test_matches_brute_force(spark):
    docs, odd = texts(spark)
    rows = [(i, t) for i, t in enumerate([*docs, *odd, docs[0], docs[0]])] + [(None, odd[0]), (3, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_a", "text AS `groups.a`").repartition(5)
    got = sorted(map(tuple, T.align(df, A, B).collect()), key=repr)
    assert got == brute(rows)
    assert T.align(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_encoders_equal_the_libraries(spark, monkeypatch):
    """Cut into pieces, too."""
    side_a, side_b = libraries()
    docs, odd = texts(spark)
    long = " ".join(odd) + " words and words " * 300 + " " * 3000 + "end"
    for piece in (1 << 18, 64):
        monkeypatch.setattr(T, "PIECE", piece)
        for side, library in ((T.load_byte_level(A), side_a), (T.load_pieces(B), side_b)):
            batch = [*docs, *odd, long]
            ids, bounds = T._encode(side, [" " + t for t in batch])
            for k, text in enumerate(batch):
                assert ids[bounds[k] : bounds[k + 1]].tolist() == list(library(text)[0])


@pytest.mark.parametrize("seed", range(4))
def test_galloping(seed):
    rng = np.random.default_rng(seed)
    a, b = (np.unique(rng.integers(0, 5000, n)) for n in ([3000, 200], [1, 4000], [70, 70], [0, 9])[seed])
    assert T.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()
    ia, ib = T.common_ends(a, b)
    assert a[ia].tolist() == b[ib].tolist() == np.intersect1d(a, b).tolist()


def test_white_space_beyond_the_pattern_matcher():
    side = T.load_byte_level(A)
    text = " " * (1 << 20) + "x"
    ids, _ = T._encode(side, [text])
    assert side.joined(ids).tobytes() == text.encode()
