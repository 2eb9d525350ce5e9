"""N-gram Jaccard join with token-combination prefixes.

A document is the set of its distinct ``shingle``-word n-grams (64-bit
hashes; a document with fewer words is one shingle, one without words is
empty). Two documents link when ``|A & B| * den >= num * |A | B|``. The
result is one row per document with the smallest document id that links
reach.

Candidates come from an extended prefix of each set in one global order:
rare tokens first, then frequent ones, each by (count, hash). A token of the
rare class is a signature by itself. Tokens of the frequent class count only
in combinations of two that are neighbours in the order, and the prefix is
extended until the combinations suffice. With ``e`` tokens a set may miss and
``f`` tokens a partner may add, ``e + 1`` single tokens suffice; with only
``a <= e`` rare tokens, ``2 (e - a) + f + 2`` frequent ones do, since a
missing token breaks two neighbour pairs and an added one breaks one. So
every linked pair of different sets shares a signature, and the number of
signatures is linear in the set size.

Of two linked sets the smaller may miss far fewer tokens than the larger: half
as many as a bound for both roles would say. Every set therefore has two lists
of signatures, one as the smaller and one as the larger of a pair (sets of
equal size are both), and a smaller meets larger ones only. Near copies of one
text below the threshold mostly have enough tokens of their own to fill the
smaller's list, and never meet. Candidates are first compared by a longer
prefix, which bounds what the sets can share, and what is left is verified on
the whole sets.

The frequency classes come from a hashed counter table over all shingles of
all documents; its size is fixed (``COUNTERS``), so it is what gets sent to
every task. A counter may be too high by what else falls in it; that moves a
token to the frequent class and never loses a link.

Hot groups: equal sets are one node, so copies are never expanded. A bucket
of a signature is first compared with one pivot per round, and members that
already share a component are not compared again. What is still apart in
larger buckets is compared by what it differs in from the bucket's pivot:
two sets differ in as many tokens as their differences from the pivot do, so
those near the pivot link only if they share a difference, or if one of them
links to the nearest of all by size alone (then both do). Near copies of one
text that differ in other places don't meet. Sets too far from the pivot for
that are compared in full with each other and with those at the rim, once for
a run of common signatures, as are the members of smaller buckets.

Null ids: such rows get their ``n_shingles`` and a null component, and link
with nothing. Null or empty texts are empty sets. Rows that repeat an id are
separate rows; rows with equal sets share a node.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainfold.llm import blocks as B
from chainfold.llm.components import component_labels
from chainfold.storage import discard, shuffle_cleanup, write_intermediate

COUNTERS = 1 << 18
PIVOT_ROUNDS = 2
#: Members of a pivot from which they are compared by their differences, and how many times the linking one these may be.
LEAST_AROUND = 16
NEAR_TIMES = 8


def shingle_sets(offsets: np.ndarray, data: np.ndarray, shingle: int, lower: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every document."""
    for i, j in B.spans(offsets):
        words = B.split_words(offsets[i : j + 1], data[offsets[i] : offsets[j]], lower)
        grams = B.ngrams(words.hashes, shingle)
        for row in range(i, j):
            a, b = words.bounds[row - i], words.bounds[row - i + 1]
            if b - a >= shingle:
                yield row, np.unique(grams[a : b - shingle + 1])
            elif b > a:
                yield row, np.array([B.whole(words.hashes[a:b])])
            else:
                yield row, grams[:0]


def misses(n: int, num: int, den: int) -> tuple[tuple[int, int], tuple[int, int]]:
    """(tokens that a set of ``n`` may miss, tokens that its partner may add), as the smaller and as the larger of a linked pair."""
    both = num + den
    most, least = n * den // num, -(-n * num // den)
    smaller = (n * (den - num) // both, (den * most - num * n) // both)
    return smaller, ((den * n - num * least) // both, n * (den - num) // both)


def signatures(
    tokens: np.ndarray, counts: np.ndarray, frequent_from: int, num: int, den: int
) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(prefix, signatures, how many of them as the smaller, as the larger of a pair) of one set.

    ``counts`` are the counters of the tokens. The prefix has the first ``2
    miss + 1`` tokens in the global order, for the most that any partner
    leaves out. The signatures as the smaller are the first of those as the
    larger. A set with enough rare tokens has the first tokens of its prefix
    as signatures; none are returned then.
    """
    n = len(tokens)
    miss = (den - num) * n // den
    often = counts >= frequent_from
    order = (often.astype(np.uint64) << np.uint64(63)) | (np.minimum(counts, (1 << 20) - 1).astype(np.uint64) << np.uint64(43)) | (tokens >> np.uint64(21))
    n_rare = n - int(np.count_nonzero(often))
    roles = misses(n, num, den)
    if n_rare > roles[1][0]:
        keep = min(2 * miss, n - 1)
        least = np.argpartition(order, keep)[: keep + 1]
        ranked = tokens[least[np.argsort(order[least], kind="stable")]]
    else:
        ranked = tokens[np.argsort(order, kind="stable")]
    (e_small, f_small), (e_large, f_large) = roles
    prefix = ranked[: 2 * miss + 1]
    if n_rare > e_large or n == 1:
        return prefix, tokens[:0], e_small + 1, e_large + 1
    frequent = ranked[n_rare : n_rare + 2 * (e_large - n_rare) + f_large + 2]
    with np.errstate(over="ignore"):
        pairs = B.mix(frequent[:-1] * np.uint64(0x9E3779B97F4A7C15) + B.mix(frequent[1:]))
    sigs = np.concatenate([ranked[:n_rare], pairs])
    n_small = e_small + 1 if n_rare > e_small else n_rare + 2 * (e_small - n_rare) + f_small + 1
    return prefix, sigs, min(n_small, len(sigs)), len(sigs)


def _counts(docs: DataFrame, text: str, shingle: int, lower: bool) -> np.ndarray:
    def count(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            offsets, data = B.text_arrays(batch.column(0))
            for i, j in B.spans(offsets):
                found = [s for _, s in shingle_sets(offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]], shingle, lower)]
                total += np.bincount(np.concatenate(found) & np.uint64(COUNTERS - 1), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["slot", "n"])

    with shuffle_cleanup(docs.sparkSession):
        rows = docs.select(text).mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COUNTERS, np.int64)
    out[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    return out


def _sketches(docs: DataFrame, id_col: str, text: str, shingle: int, num: int, den: int, lower: bool) -> DataFrame:
    """doc_id, n_shingles, set_id (hash of the set), prefix, sigs, n_small and n_large (signatures by role) of every row."""
    counts = _counts(docs, text, shingle, lower)
    mean = counts.mean()
    frequent_from = int(mean + 32 + 6 * np.sqrt(mean))
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(counts, np.iinfo(np.int32).max).astype(np.int32))

    def sketch(batches):
        table = shared.value
        for batch in batches:
            offsets, data = B.text_arrays(batch.column(1))
            for i, j in B.spans(offsets):
                sizes, sets, lists = [], [], []
                for _, tokens in shingle_sets(offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]], shingle, lower):
                    sizes.append(len(tokens))
                    sets.append(B.whole(tokens))
                    counters = table[tokens & np.uint64(COUNTERS - 1)]
                    lists.append(signatures(tokens, counters, frequent_from, num, den) if len(tokens) else (tokens, tokens, 0, 0))
                arrays = [B.long_array([found[k] for found in lists]) for k in (0, 1)]
                arrays += [pa.array([found[k] for found in lists], pa.int32()) for k in (2, 3)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(sizes, pa.int64()), pa.array(np.array(sets, np.uint64).view(np.int64)), *arrays],
                    ["doc_id", "n_shingles", "set_id", "prefix", "sigs", "n_small", "n_large"],
                )

    return docs.select(F.col(id_col).cast("long"), text).mapInArrow(
        sketch, "doc_id long, n_shingles long, set_id long, prefix array<long>, sigs array<long>, n_small int, n_large int"
    )


def _sets(docs: DataFrame, id_col: str, text: str, wanted: DataFrame, shingle: int, lower: bool) -> DataFrame:
    """The whole sets of the wanted (set_id, rep) nodes, computed anew from their texts."""

    def expand(batches):
        for batch in batches:
            offsets, data = B.text_arrays(batch.column(1))
            found = [s for _, s in shingle_sets(offsets, data, shingle, lower)]
            same = [k for k, s in enumerate(found) if len(s) and B.whole(s).astype(np.int64) == batch.column(0)[k].as_py()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(same, pa.int64())), B.long_array([found[k] for k in same])], ["set_id", "tokens"]
            )

    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text).alias("text"))
    return texts.join(wanted, "rep").select("set_id", "text").mapInArrow(expand, "set_id long, tokens array<long>")


def _with_both(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with ``both``, the number of tokens common to their lists, the sizes ``na``, ``nb`` of the sets, and ``rest``, the most tokens that a set has beyond its list."""
    left = lists.select(F.col("set_id").alias("a"), F.col("tokens").alias("ta"), F.col("n").alias("na"))
    right = lists.select(F.col("set_id").alias("b"), F.col("tokens").alias("tb"), F.col("n").alias("nb"))
    met = pairs.join(left, "a").join(right, "b")
    rest = F.greatest(F.col("na") - F.size("ta"), F.col("nb") - F.size("tb"))
    return met.select("a", "b", F.size(F.array_intersect("ta", "tb")).alias("both"), "na", "nb", rest.alias("rest"))


def _links(pairs: DataFrame, prefixes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], num: int, den: int) -> DataFrame:
    """The linked ones among candidate pairs.

    Of two prefixes, take the one that ends first in the global order. What
    it holds of its partner's tokens stands in the partner's prefix too, so
    the sets share no more than the prefixes do and the rest of that set.
    What passes is verified on the whole sets.
    """
    enough = (F.col("both") + F.col("rest")) * (den + num) >= (F.col("na") + F.col("nb")) * num
    near = write_intermediate(_with_both(pairs, prefixes).where(enough).select("a", "b"), "ngram-near")
    nodes = near.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    sets = write_intermediate(sets_of(nodes).withColumn("n", F.size("tokens").cast("long")), "ngram-sets")
    same = F.col("both") * den >= (F.col("na") + F.col("nb") - F.col("both")) * num
    links = write_intermediate(_with_both(near, sets).where(same).select("a", "b").distinct(), "ngram-links")
    discard(near)
    discard(sets)
    return links


def _around_pivots(members: DataFrame, sets_of: Callable[[DataFrame], DataFrame], num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(pivot, set_id, inner of the members near a pivot; the links (a, b) among them that join components).

    ``members`` has pivot, set_id, label and n. With ``d(x)`` the symmetric
    difference of ``x`` and the pivot, ``x`` and ``y`` differ in ``|d(x)| +
    |d(y)| - 2 |d(x) & d(y)|`` tokens, and link up to ``(n(x) + n(y)) (den -
    num) / (den + num)``. They differ in ``|d(x)| - |d(y)|`` at least, so the
    ``inner`` members link with no set beyond those near the pivot.
    """
    many = members.groupBy("pivot").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > LEAST_AROUND).select("pivot")
    members = members.join(many, "pivot")
    sets = write_intermediate(sets_of(members.select(F.explode(F.array("set_id", "pivot")).alias("set_id")).distinct()), "ngram-sets")
    pivots = sets.select(F.col("set_id").alias("pivot"), F.col("tokens").alias("of_pivot"))
    apart = F.concat(F.array_except("tokens", "of_pivot"), F.array_except("of_pivot", "tokens"))
    size = F.size("d").cast("long")
    near = members.join(sets, "set_id").join(pivots, "pivot").select("pivot", "set_id", "label", "n", apart.alias("d"))
    near = near.where(size * (den + num) <= NEAR_TIMES * F.col("n") * (den - num))
    near = write_intermediate(near.withColumn("size", size).withColumn("over", size * (den + num) - F.col("n") * (den - num)), "ngram-around")
    discard(sets)
    # two sets link by size alone if their overs add up to 0 at most, and then both link to the least of all
    least = near.groupBy("pivot").agg(F.min(F.struct("over", "set_id")).alias("least"))
    star = near.join(least, "pivot").where((F.col("over") + F.col("least.over") <= 0) & (F.col("set_id") != F.col("least.set_id")))
    by_size = star.select(F.col("least.set_id").alias("p"), "set_id")
    # The others share differences. Ordered by ``over``, the lower of a pair shares ``over / (den + num)`` of its own
    # with the upper at least, the upper half of its and the least over: prefixes in a common order, rare ones first.
    tokens = near.select("pivot", F.explode("d").alias("token"), "set_id", "label", "over", "size")
    often = tokens.groupBy("pivot", "token").agg(F.count(F.lit(1)).alias("m"))
    ranked = tokens.join(often, ["pivot", "token"]).withColumn("at", F.row_number().over(Window.partitionBy("pivot", "set_id").orderBy("m", "token")))
    floor = near.where("size > 0").groupBy("pivot").agg(F.min("over").alias("floor"))
    at_least = lambda over, by: F.greatest(F.lit(1), F.ceil(over / by))
    lower = F.col("at") <= F.col("size") - at_least(F.col("over"), den + num) + 1
    upper = F.col("at") <= F.col("size") - at_least(F.col("over") + F.col("floor"), 2 * (den + num)) + 1
    after = F.col("size") - F.col("at") + 1
    kept = ranked.where("m > 1").join(floor, "pivot").where(upper).select("pivot", "token", "set_id", "label", "over", after.alias("after"), lower.alias("lower"))
    kept = write_intermediate(kept, "ngram-differences")
    other = kept.select("pivot", "token", *(F.col(c).alias(k) for c, k in (("set_id", "p"), ("label", "p_label"), ("over", "p_over"), ("after", "p_after"))))
    below = F.struct("over", "set_id") < F.struct(F.col("p_over"), F.col("p"))
    # from the first token that a pair shares, both have as many as it must share
    enough = F.col("over") + F.col("p_over") <= 2 * (den + num) * F.least("after", "p_after")
    met = kept.where("lower").join(other, ["pivot", "token"]).where(below & enough & (F.col("label") != F.col("p_label"))).select("pivot", "set_id", "p").distinct()
    own = near.select("pivot", "set_id", "d", "n", "size")
    held = met.join(own, ["pivot", "set_id"]).join(own.select("pivot", *(F.col(c).alias(k) for c, k in (("set_id", "p"), ("d", "p_d"), ("n", "p_n"), ("size", "p_size")))), ["pivot", "p"])
    differ = F.col("size") + F.col("p_size") - 2 * F.size(F.array_intersect("d", "p_d"))
    by_tokens = held.where(differ * (den + num) <= (F.col("n") + F.col("p_n")) * (den - num)).select("p", "set_id")
    both = by_size.unionByName(by_tokens)
    links = both.select(F.least("set_id", "p").alias("a"), F.greatest("set_id", "p").alias("b")).distinct()
    # A set beyond has more than NEAR_TIMES its n, and its n is num / den of a linked one's at least.
    inner = (F.col("size") * (den + num) + F.col("n") * (den - num)) * den <= (NEAR_TIMES - 1) * F.col("n") * (den - num) * num
    return near.select("pivot", "set_id", inner.alias("inner")), write_intermediate(links, "ngram-links")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    num: int = 80,
    den: int = 100,
    lower: bool = True,
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``; see the module text."""
    if not 0.75 <= num / den <= 1:
        raise ValueError("the prefix bounds hold for thresholds from 0.75 to 1")
    sketch = write_intermediate(_sketches(docs, id_col, text_col, shingle, num, den, lower), "ngram-sketch")
    rows = sketch.where("n_shingles > 0 and doc_id is not null")
    nodes = write_intermediate(rows.groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n")), "ngram-nodes")
    first = nodes.select("set_id", F.col("rep").alias("doc_id"))
    # Each signature comes with the one before it, the first with the set's own number.
    own = F.when(F.size("sigs") > 0, F.col("sigs")).otherwise(F.slice("prefix", F.lit(1), F.col("n_large")))
    listed = rows.join(first, ["set_id", "doc_id"], "left_semi").select("set_id", F.col("n_shingles").alias("n"), "n_small", own.alias("own"))
    small = F.transform("own", lambda _, at: at < F.col("n_small"))
    chain = F.arrays_zip(
        F.col("own").alias("token"), F.concat(F.array("set_id"), F.slice("own", F.lit(1), F.size("own") - 1)).alias("before"), small.alias("small")
    )
    # Of interest is a token that two sets have, one of them as the smaller.
    alike = Window.partitionBy("token")
    entries = listed.select("set_id", "n", F.inline(chain)).select("*", F.count(F.lit(1)).over(alike).alias("m"), F.max("small").over(alike).alias("s")).where("m > 1 and s")
    # Linked sets differ in size by at most den / num, so a smaller meets larger ones of its own size class or the next.
    size_class = (F.floor(F.log(F.col("n").cast("double")) / log(den / num)) if num < den else F.col("n")).cast("long")
    sized = entries.withColumn("down", F.explode(F.array(F.lit(0), F.lit(1))))
    sized = sized.select(F.xxhash64("token", size_class - F.col("down")).alias("sig"), "set_id", "n", "before", (F.col("small") & (F.col("down") == 0)).alias("small"))
    sized = write_intermediate(sized, "ngram-sized")
    met = sized.groupBy("sig").agg(F.min("set_id").alias("lo"), F.max("set_id").alias("hi"), F.max("small").alias("s")).where("lo < hi and s").select("sig")
    buckets = write_intermediate(sized.join(met, "sig"), "ngram-buckets")
    discard(sized)

    members = buckets.select("set_id").distinct()
    of_members = rows.join(first, ["set_id", "doc_id"], "left_semi").join(members, "set_id", "left_semi")
    prefixes = write_intermediate(of_members.select("set_id", F.col("prefix").alias("tokens"), F.col("n_shingles").alias("n")), "ngram-prefixes")

    def sets_of(wanted: DataFrame) -> DataFrame:
        return _sets(docs, id_col, text_col, nodes.select("set_id", "rep").join(wanted, "set_id", "left_semi"), shingle, lower)

    links = None
    labels = buckets.select("set_id").distinct().withColumn("label", F.col("set_id"))
    for turn in range(PIVOT_ROUNDS + 1):
        named = buckets.join(labels, "set_id")
        apart = named.groupBy("sig").agg(
            F.min("label").alias("lo"),
            F.max("label").alias("hi"),
            F.min(F.struct(F.xxhash64("set_id", F.lit(turn)), "set_id", "label", "n")).alias("p"),
        ).where("lo < hi")
        close = F.least("n", "pn") * den >= F.greatest("n", "pn") * num
        if turn < PIVOT_ROUNDS:
            met = named.join(apart.select("sig", F.col("p.set_id").alias("p"), F.col("p.label").alias("pl"), F.col("p.n").alias("pn")), "sig")
            met = met.where((F.col("label") != F.col("pl")) & close)
        else:
            left = named.join(apart.select("sig", F.col("p.set_id").alias("pivot")), "sig")
            near, found = _around_pivots(left.select("pivot", "set_id", "label", "n").distinct(), sets_of, num, den)
            links = links.unionByName(found)
            left = left.join(near.withColumn("near", F.lit(True)), ["pivot", "set_id"], "left").where("inner is null or not inner")
            left = left.withColumn("near", F.coalesce("near", F.lit(False)))
            own = left.where("small")
            other = left.select(
                "sig", F.col("set_id").alias("p"), F.col("label").alias("pl"), F.col("n").alias("pn"), F.col("before").alias("pb"), F.col("near").alias("p_near")
            )
            # A pair that also shares the signature before this one meets there.
            ordered = (F.col("n") < F.col("pn")) | ((F.col("n") == F.col("pn")) & (F.col("set_id") < F.col("p")))
            new = ordered & (F.col("label") != F.col("pl")) & (F.col("before") != F.col("pb")) & ~(F.col("near") & F.col("p_near"))
            met = own.join(other, "sig").where(new & close)
        pairs = met.select(F.least("set_id", "p").alias("a"), F.greatest("set_id", "p").alias("b")).distinct()
        found = _links(pairs, prefixes, sets_of, num, den)
        links = found if links is None else links.unionByName(found)
        labels = component_labels(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        labels = (
            buckets.select("set_id").distinct()
            .join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
            .withColumn("label", F.coalesce("label", "set_id"))
        )
        labels = write_intermediate(labels, "ngram-labels")

    linked = labels.join(nodes.select("set_id", "rep"), "set_id")
    smallest = linked.groupBy("label").agg(F.min("rep").alias("component_id"))
    merged = linked.join(smallest, "label").select("set_id", "component_id")
    alone = nodes.select("set_id", "rep").join(merged, "set_id", "left")
    component = write_intermediate(alone.select("set_id", F.coalesce("component_id", "rep").alias("component_id")), "ngram-components")
    discard(prefixes)
    discard(buckets)
    # An empty set has no node: its row keeps its own id.
    return sketch.select("doc_id", "n_shingles", "set_id").join(component, "set_id", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose id is not the smallest of its component.

    Every group keeps the row (or rows, if the id repeats) with its smallest
    id; rows without an id stay.
    """
    id_col = options.get("id_col", "doc_id")
    found = near_duplicates(docs, **options)
    gone = found.where("doc_id > component_id").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)
