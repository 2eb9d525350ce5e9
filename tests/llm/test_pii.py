from __future__ import annotations

import math
import random
import re
import time

from pyspark.sql import functions as F

from chainfold.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }
            if good[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_against_plain_patterns(spark):
    rnd = random.Random(5)
    texts = [None, "", "a@b.c_x@d.e", "x@y.z@q.r", "é\U0001f600 a.b@c-d.org, 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255", "+1 (499) 555-6503. +123 +12345678 9"]
    texts += ["4111 1111 1111 1111 4111-1111-1111-1111", "4785380592391139", "9" * 30_000, "a." * 30_000, "+" + "1" * 20_000, "1.2.3.4@x.y", "1." * 9000]
    texts += ["".join(rnd.choice("a1.@+- (9é\U0001f6004") for _ in range(rnd.randint(0, 60))) for _ in range(2500)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(4)
    found = pii.find(docs)
    got = {r["doc_id"]: [tuple(s) for s in r["spans"] if s["kind"] != "term"] for r in found.collect()}
    assert all(got[i] == plain_spans(t) for i, t in enumerate(texts))
    assert "Python" not in found._jdf.queryExecution().toString()


def disclosure_corpus():
    """An address that always comes with one name, under common words, in different texts."""
    rows = [(i, f"filler number{i} words here the and of to in text{i}") for i in range(60)]
    rows += [(100 + i, f"the note{i} of Zabrinsky, write to kay@mail.example.org about item{i} and the rest") for i in range(5)]
    rows += [(200 + i, f"the call{i} with ip 10.0.0.{i} and the rest") for i in range(5)]
    rows += [(300, "the once only Quimby wrote from solo@mail.example.org")]
    return rows


def plain_terms(rows):
    """doc -> {term: disclosure} by the formula, on whole texts shorter than the context."""
    n = len(rows)
    words = {i: {w.lower().strip(pii._TRIM) for w in t.split()} for i, t in rows}
    entities = {}
    for i, t in rows:
        for kind, a, b in plain_spans(t):
            entities.setdefault(f"{kind}:{t[a:b].lower()}", set()).add(i)
    out = {}
    for docs in entities.values():
        for term in {w for i in docs for w in words[i]}:
            both = [i for i in docs if term in words[i]]
            if both and len(docs) < n:
                single = (sum(term in w for w in words.values()) + pii.SMOOTH) * (len(docs) + pii.SMOOTH)
                share = math.log(len(both) * n / single) / math.log(n / len(docs))
                if share >= pii.GENERALISE_FROM:
                    for i in both:
                        out.setdefault(i, set()).add(term)
    return out


def test_telling_terms_follow_the_formula(spark):
    rows = disclosure_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    got = {}
    for r in pii.find(docs).collect():
        terms = {texts[r["doc_id"]][s["start"] : s["end"]].lower().strip(pii._TRIM) for s in r["spans"] if s["kind"] == "term"}
        if terms:
            got[r["doc_id"]] = terms
    want = {i: {t for t in terms if "@" not in t} for i, terms in plain_terms(rows).items()}
    assert got == want and "zabrinsky" in got[100] and 300 not in got and "the" not in got[100]


def test_sanitise(spark):
    rows = [*disclosure_corpus(), (400, None), (401, ""), (None, "null id a@b.cd"), (402, "card 4111 1111 1111 1111 end"), (402, "card 4111 1111 1111 1111 end")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, __row int")
    out = pii.sanitise(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    by = {}
    for r in out.collect():
        by.setdefault(r["doc_id"], []).append(r["text"])
    assert by[400] == [None] and by[401] == [""] and by[None] == ["null id [EMAIL]"]
    assert by[402] == ["card [CARD] end"] * 2
    assert "Zabrinsky" not in by[100][0] and "[EMAIL]" in by[100][0] and "the" in by[100][0]
    assert all(by[i][0] == t for i, t in rows if i is not None and i < 100)
    assert pii.sanitise(docs.where(F.lit(False))).collect() == [] and pii.find(docs.where(F.lit(False))).collect() == []


def test_one_meeting_in_a_larger_corpus(spark):
    rows = [(i, f"the and of to in with filler{i} words") for i in range(400)]
    rows += [(500, "the Quimby wrote to solo@mail.example.org with words")] * 3
    found = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s["start"], s["end"]) for s in found[500] if s["kind"] == "term"] == [(4, 10), (11, 16)]


def test_telling_terms_anywhere_in_the_document(spark):
    far = "and of to in " * 90
    rows = [(i, f"the and of to in with filler{i} words") for i in range(300)]
    rows += [(400 + i, f"Zabrinsky {far} kay@mail.example.org {far} \t(zabrinsky), the end{i}") for i in range(4)]
    rows += [(500, "the Zabrinsky without an address")]
    found = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(400, 404):
        text = dict(rows)[i]
        terms = [text[s["start"] : s["end"]] for s in found[i] if s["kind"] == "term"]
        assert terms[:2] == ["Zabrinsky", "(zabrinsky),"] and "the" not in terms
    assert found[500] == []


def test_a_text_with_thousands_of_entities(spark):
    """Linear in the matches, and entities of the same texts count once."""
    many = " ".join(f"u{i}@h{i % 7}.example.org" for i in range(20_000))
    names = " ".join(f"Name{i}" for i in range(2000))
    rows = [(i, f"the and of to in with filler{i} words") for i in range(300)] + [(900, f"{many} {names}"), (901, "the u1@h1.example.org Name1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    started = time.monotonic()
    found = {r["doc_id"]: r["spans"] for r in pii.find(docs).collect()}
    assert time.monotonic() - started < 120
    text = dict(rows)[900]
    emails = [s for s in found[900] if s["kind"] == "email"]
    assert [text[s["start"] : s["end"]] for s in emails] == many.split(" ")
    assert sum(s["kind"] == "term" for s in found[900]) >= 1999
