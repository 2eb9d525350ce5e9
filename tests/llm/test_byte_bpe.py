from __future__ import annotations

import base64
import random

import public_tokenizers
import pytest
import tiktoken

from chainfold.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rnd = random.Random(3)
    out = ["", None, "aaaaaaaaaaaaaaaaaaaaaaaaaa aaaaa", "   \n\n  x", "<|endoftext|>", "é́\U0001f600" * 50, "'", "'s it's 'S 've''s \n's ''re 'llama 'l", " ", "x'"]
    return out + ["".join(rnd.choice("abcresvtmld 12'\n\t 　é中٣'’") for _ in range(rnd.randint(0, 60))) for _ in range(1500)] + ["abc " * 40_000]


@pytest.mark.parametrize("pattern", [public_tokenizers.PATTERN, public_tokenizers.PATTERN + "|(?!)"])
def test_ids_and_round_trip(spark, reference, pattern):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, "old") for i, t in rows], "doc_id long, text string, ids string").repartition(3)
    encoded = byte_bpe.encode(docs, PATH, pattern)
    assert encoded.columns == ["doc_id", "ids"]
    got = {r["doc_id"]: (r["ids"], bytes(r["decoded"])) for r in byte_bpe.decode(encoded, PATH).collect()}
    for i, t in rows:
        assert got[i] == (reference.encode_ordinary(t or ""), (t or "").encode())


def test_blocks_do_not_change_the_result(spark, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", 200)
    docs = spark.createDataFrame([(i, f"some text {i} here") for i in range(50)], "doc_id long, text string")
    assert all(r["ids"] == reference.encode_ordinary(f"some text {r['doc_id']} here") for r in byte_bpe.encode(docs, PATH, public_tokenizers.PATTERN).collect())


def test_empty_table_and_unknown_ids(spark):
    assert byte_bpe.encode(spark.createDataFrame([], "doc_id long, text string"), PATH, public_tokenizers.PATTERN).collect() == []
    one = spark.createDataFrame([(1, [1, 2]), (2, None)], "doc_id long, ids array<int>")
    assert [bytes(r["decoded"]) for r in byte_bpe.decode(one, PATH).orderBy("doc_id").collect()][1] == b""
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([(1, [50_400])], "doc_id long, ids array<int>"), PATH).collect()
