"""Personal data: base patterns and information-theoretic sanitisation (DataFrame operations only).

Base spans are leftmost, non-overlapping matches per kind (email, ip, card,
phone) that pass the kind's test. They are the protected entities. Corpus
co-occurrence then tells which other terms give an entity away: with ``N``
texts, a term ``t`` beside an entity ``e`` discloses the share

    PMI(t, e) / IC(e) = log(n(t, e) N / ((n(t) + s) (n(e) + s))) / log(N / n(e))

of the entity's information. All counts are different texts of the whole
corpus, so copies prove nothing more; ``n(t, e)`` counts those with both,
however far apart. ``SMOOTH`` (s) discounts pairs of few meetings: a single
one loses log 2.25 of its PMI, which weighs less the more information the
entity has, so from some 220 texts on it can tell. Terms from ``REMOVE_FROM``
are removed, from ``GENERALISE_FROM`` generalised, at every occurrence in
every document that holds the entity. Documents without a protected entity
are never changed.

Positions come from the matches and the gaps between them, in code points,
end exclusive. The patterns are possessive and start at ``\\G`` or outside
their own character class, which finds the same matches as plain ones in
linear time and without recursion.

Only rows with an entity are written out and joined, one of each text.
Entities that occur in the same texts are counted as one, so a list of
thousands that stand in one text is one partner of that text's terms. The
document frequency is one pass over all words; the words of a text with n
copies count 1 / n, so that partial sums give different texts. A pair is
counted only if it could tell with every possible meeting, which drops no
telling pair and leaves the common words out.

Edge cases: null and empty texts have no spans (sanitised texts keep null);
rows with null or repeated ids are handled one by one; an entity in every
document has no information and discloses nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainfold.storage import write_intermediate

REMOVE_FROM = 0.95
GENERALISE_FROM = 0.85
SMOOTH = 0.5
#: Matches whose positions are summed at once.
RUN = 256

_SPACE = r"[\x20\x09-\x0D]"
_TRIM = ".,;:!?\"'()[]{}*#$%&|<>-"

# The kinds in order, a cheap test whether a text can hold one, and the pattern.
KINDS = {
    "email": ("[@]", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    # a chain of fewer than 16 digits can't pass, nor can a part of it
    "card": (r"[0-9](?:[\x20-]?[0-9]){15}", r"[0-9](?:[\x20-]?[0-9]){15,}+"),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def _passes(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _positions(text: Column, pattern: str) -> Column:
    """array of (start, end, value) of every match of ``pattern``."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("value")))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def add(state: Column, step: Column) -> Column:
        start = state.getField("at") + step.getField("gap")
        end = start + F.length(step.getField("value"))
        span = F.struct(start.alias("start"), end.alias("end"), step.getField("value").alias("value"))
        return F.struct(end.alias("at"), F.array_append(state.getField("out"), span).alias("out"))

    # An array grows by copying, so positions are summed in runs, from where the runs before end.
    last = F.greatest(F.ceil(F.size(found) / RUN).cast("int") - 1, F.lit(0))
    runs = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(steps, k * RUN + 1, F.lit(RUN)))
    ends = F.transform(runs, lambda run: F.aggregate(run, F.lit(0), lambda n, step: n + step.getField("gap") + F.length(step.getField("value"))))
    starts = F.aggregate(ends, F.array(F.lit(0)), lambda out, n: F.array_append(out, F.element_at(out, -1) + n))
    return F.flatten(
        F.zip_with(
            runs,
            F.slice(starts, F.lit(1), F.size(runs)),
            lambda run, at: F.aggregate(run, F.struct(at.alias("at"), none.alias("out")), add, lambda s: s.getField("out")),
        )
    )


def _kind_spans(text: Column, kind: str, test: str, pattern: str) -> Column:
    kept = F.filter(_positions(text, pattern), lambda s: _passes(kind, s.getField("value")))
    named = F.transform(
        kept,
        lambda s: F.struct(
            F.lit(kind).alias("kind"), s.getField("start").alias("start"), s.getField("end").alias("end"), s.getField("value").alias("value")
        ),
    )
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")
    return F.when(F.rlike(text, F.lit(test)), named).otherwise(none)


def base_spans(text: Column) -> Column:
    """array of (kind, start, end, value) by kind as listed, then start."""
    return F.concat(*(_kind_spans(text, kind, test, pattern) for kind, (test, pattern) in KINDS.items()))


def _entity_rows(docs: DataFrame, text_col: str) -> DataFrame:
    """Rows with an entity: row (a number), doc (all columns of ``docs``), text, text_hash, spans."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.struct("*").alias("doc"), text.alias("text")).where("text is not null").withColumn("spans", base_spans(F.col("text")))
    rows = rows.where(F.size("spans") > 0).select(F.monotonically_increasing_id().alias("row"), "doc", "text", F.xxhash64("text").alias("text_hash"), "spans")
    return write_intermediate(rows, "pii-rows")


def _no_entity(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.where(F.size(base_spans(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))) == 0)


def _term(word: Column) -> Column:
    return F.lower(F.btrim(word, F.lit(_TRIM)))


def _terms(text: Column) -> Column:
    """The distinct terms of a text."""
    words = F.array_distinct(F.split(F.lower(text), _SPACE))
    return F.array_distinct(F.filter(F.transform(words, _term), lambda t: F.length(t) > 1))


def _frequency(docs: DataFrame, text_col: str) -> tuple[DataFrame, int]:
    """term, n_term of all terms, and the number of texts."""
    texts = docs.select(F.col(f"`{text_col}`").alias("text")).where("text is not null").select(F.xxhash64("text").alias("text_hash"), "text")
    copies = write_intermediate(texts.groupBy("text_hash").agg(F.count(F.lit(1)).alias("n")), "pii-copies")
    repeated = copies.where("n > 1")
    each = texts.join(repeated, "text_hash", "left").select((1 / F.coalesce("n", F.lit(1))).alias("share"), F.explode(_terms(F.col("text"))).alias("term"))
    return each.groupBy("term").agg(F.round(F.sum("share")).cast("long").alias("n_term")), copies.count()


def _disclosing_terms(docs: DataFrame, hits: DataFrame, firsts: DataFrame, text_col: str) -> DataFrame:
    """text_hash, term, disclosure (the largest of the text's entities) at or above the lower threshold."""
    entities = hits.select("text_hash", F.explode("spans").alias("s")).select("text_hash", F.concat_ws(":", "s.kind", F.lower("s.value")).alias("entity"))
    entities = write_intermediate(entities.distinct(), "pii-entities")
    # Entities of the same texts give the same counts with every term: they are one, whatever their number in a text.
    where = F.xxhash64("text_hash").cast("decimal(20,0)"), F.xxhash64(F.lit("second"), "text_hash").cast("decimal(20,0)")
    counts = entities.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"), F.sum(where[0]).alias("one"), F.sum(where[1]).alias("two"))
    counts = counts.select("entity", "n_entity", F.xxhash64("n_entity", "one", "two").alias("class"))
    entities = write_intermediate(entities.join(counts, "entity").select("text_hash", F.col("class").alias("entity"), "n_entity").distinct(), "pii-classes")
    frequency, size = _frequency(docs, text_col)
    most = entities.agg(F.max("n_entity")).first()[0] or 0

    def disclosure(n_both: Column) -> Column:
        shared = F.log(n_both * float(size) / ((F.col("n_term") + SMOOTH) * (F.col("n_entity") + SMOOTH)))
        return shared / F.log(F.lit(float(size)) / F.col("n_entity"))

    # n(t, e) <= n(e) and PMI >= GENERALISE_FROM * IC bound n(t), the more loosely the larger n(e)
    bound = max(most, size ** (1 - GENERALISE_FROM) * most**GENERALISE_FROM) + 1
    rarer = write_intermediate(frequency.where(F.col("n_term") <= bound), "pii-frequency")
    words = hits.join(firsts, "row", "left_semi").select("text_hash", F.explode(_terms(F.col("text"))).alias("term")).join(rarer, "term")
    sized = entities.where(F.col("n_entity") < size)
    able = disclosure(F.least("n_term", "n_entity")) >= GENERALISE_FROM
    pairs = write_intermediate(words.join(sized, "text_hash").where(able), "pii-pairs")
    telling = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both"), F.first("n_term").alias("n_term"), F.first("n_entity").alias("n_entity"))
    telling = telling.select("entity", "term", disclosure(F.col("n_both")).alias("disclosure")).where(F.col("disclosure") >= GENERALISE_FROM)
    return pairs.join(telling, ["entity", "term"]).groupBy("text_hash", "term").agg(F.max("disclosure").alias("disclosure"))


def _places(hits: DataFrame, firsts: DataFrame, telling: DataFrame) -> DataFrame:
    """text_hash, terms (start, end, action in order): every occurrence of a text's telling terms."""
    texts = hits.join(firsts, "row", "left_semi").join(telling.select("text_hash").distinct(), "text_hash", "left_semi")
    words = texts.select("text_hash", F.posexplode(F.split("text", _SPACE, -1)).alias("at", "word"))
    end = F.sum(F.length("word") + 1).over(Window.partitionBy("text_hash").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)) - 1
    placed = words.withColumn("end", end.cast("int")).withColumn("term", _term(F.col("word"))).where(F.length("term") > 1)
    action = F.when(F.col("disclosure") >= REMOVE_FROM, "remove").otherwise("generalise").alias("action")
    found = placed.join(telling, ["text_hash", "term"]).select("text_hash", F.struct((F.col("end") - F.length("word")).alias("start"), "end", action).alias("t"))
    return found.groupBy("text_hash").agg(F.array_sort(F.collect_list("t")).alias("terms"))


def _marked(docs: DataFrame, text_col: str) -> DataFrame:
    """Rows with an entity: doc, text, spans, terms (start, end, action), both in order."""
    hits = _entity_rows(docs, text_col)
    firsts = write_intermediate(hits.groupBy("text_hash").agg(F.min("row").alias("row")).select("row"), "pii-firsts")
    telling = write_intermediate(_disclosing_terms(docs, hits, firsts, text_col), "pii-disclosing")
    places = _places(hits, firsts, telling)
    none = F.array().cast("array<struct<start:int,end:int,action:string>>")

    def free(term: Column) -> Column:
        return ~F.exists("spans", lambda s: (s.getField("start") < term.getField("end")) & (term.getField("start") < s.getField("end")))

    return hits.join(places, "text_hash", "left").withColumn("terms", F.filter(F.coalesce("terms", none), free)).drop("row", "text_hash")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans (array of kind, start, end) of every row; the kind ``term`` comes from the method."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marked = write_intermediate(_marked(rows, "text"), "pii-marked")
    kind = "array<struct<kind:string,start:int,end:int>>"
    base = F.transform("spans", lambda s: F.struct(s.getField("kind").alias("kind"), s.getField("start").alias("start"), s.getField("end").alias("end")))
    terms = F.transform("terms", lambda s: F.struct(F.lit("term").alias("kind"), s.getField("start").alias("start"), s.getField("end").alias("end")))
    with_spans = marked.select(F.col("doc.doc_id").alias("doc_id"), F.concat(base, terms).cast(kind).alias("spans"))
    return with_spans.unionByName(_no_entity(rows, "text").select("doc_id", F.array().cast(kind).alias("spans")))


def sanitise(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with entities replaced by their kind, telling terms generalised (``[TERM]``) or removed."""
    marked = write_intermediate(_marked(docs, text_col), "pii-marked")

    def change(span: Column, by: Column) -> Column:
        return F.struct(span.getField("start").alias("start"), span.getField("end").alias("end"), by.alias("by"))

    base = F.transform("spans", lambda s: change(s, F.concat(F.lit("["), F.upper(s.getField("kind")), F.lit("]"))))
    terms = F.transform("terms", lambda s: change(s, F.when(s.getField("action") == "remove", "").otherwise("[TERM]")))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(state: Column, span: Column) -> Column:
        at, start = state.getField("at"), span.getField("start")
        piece = F.concat(F.substring("text", at + 1, F.greatest(F.lit(0), start - at)), F.when(span.getField("end") > at, span.getField("by")).otherwise(""))
        return F.struct(F.greatest(at, span.getField("end")).alias("at"), F.array_append(state.getField("out"), piece).alias("out"))

    def close(state: Column) -> Column:
        return F.concat(F.array_join(state.getField("out"), ""), F.substring("text", state.getField("at") + 1, F.length("text")))

    text = F.aggregate(F.array_sort(F.concat(base, terms)), begin, add, close)
    changed = marked.select(F.col("doc").withField(f"`{text_col}`", text).alias("doc")).select("doc.*")
    return changed.unionByName(_no_entity(docs, text_col))
