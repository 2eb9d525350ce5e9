"""Mixing sources to target weights with soft domain membership (DataFrame operations only).

1. A labelled table (id, domain) trains a naive Bayes classifier: counts of
   hashed words (``WORD_BUCKETS``) and of the last character of words, by
   domain. It uses at most ``MOST_LABELLED`` labelled ids, the first by a hash
   of the id, so they can be broadcast and documents are not shuffled.
2. Every document gets domain posteriors from its whole text. The log
   likelihood is tempered by ``n ** TEMPER``, since words are not independent.
3. Projected gradient finds document rates ``r >= 0`` with
   ``sum(r * tokens * posterior)`` by domain equal to the target totals
   (shares of all tokens). Each step is one distributed sum of one number per
   domain; a document's rate is a function of its posteriors and the few
   gradients so far, and becomes a column after every ``STEPS_HELD`` steps.
   The residuals are weighted by the inverse of the domains' Gram matrix
   (``sum(tokens * p_j * p_k)``): in that metric the step size 1 always
   converges, and a step that meets no bound ends at the targets. Steps end
   when the targets are met, or when a step moves no total any more. Rates
   end at ``MOST_RATE`` copies, so a domain that hardly exists is not made of one
   document; what such a target lacks shows in ``Mix.reached``.

Rates are an expected number of copies; ``take_copies`` draws them by a hash
of the id, at least the whole part of the rate each.

Edge cases: rows with the same id and text are one unit whose tokens add up.
Null and empty texts have no tokens and get the prior, so their rate is
defined but changes no total. Null ids are units as others. A label whose
domain has no target is left out, as is a null one; a target domain without
labelled text cannot be steered and is reported by ``Mix.reached``. Without
any labelled text all posteriors are equal and all rates 1.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainfold.storage import discard, write_intermediate

WORD_BUCKETS = 1 << 15
TAILS = 128
MOST_LABELLED = 20_000
SMOOTH = 0.5
SHRINK = 3.0
MOST_RATE = 8.0
TEMPER = -0.25
MOST_STEPS = 60
STEPS_HELD = 6
RIDGE = 1e-9
TOLERANCE = 1e-4

_SPLIT = r"[\x20\x09-\x0D]+"


@dataclass
class Mix:
    """``units``: id, text_hash, n_tokens, posteriors (map), rate; ``reached``: share of tokens by domain at these rates."""

    units: DataFrame
    reached: dict[str, float]
    steps: int


def _slot(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(WORD_BUCKETS)).cast("int")


def _tail(word: Column) -> Column:
    return F.least(F.ascii(F.substring(word, -1, 1)), F.lit(TAILS - 1))


def _model(docs: DataFrame, labelled: DataFrame, domains: list[str]) -> tuple[list[Column], list[Column], list[float]]:
    """Log likelihoods against the first domain by word slot and by tail (one array per other domain), and the log priors.

    The arrays are scalar subqueries over written tables: their values stand
    neither in Python nor in the text of plans, of which the driver makes many
    copies.
    """
    known = labelled.where(F.col("domain").isin(domains) & F.col("id").isNotNull()).groupBy("id").agg(F.min("domain").alias("domain"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(MOST_LABELLED)
    split = F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), _SPLIT)
    words = docs.join(F.broadcast(known), "id").select("domain", F.explode(split).alias("w")).where("w != ''")
    features = words.select("domain", F.explode(F.array(_slot(F.col("w")), _tail(F.col("w")) + WORD_BUCKETS)).alias("feature"))
    counts = features.groupBy("domain", "feature").agg(F.count(F.lit(1)).alias("n"))
    counts = write_intermediate(counts, "mixing-counts")
    sizes = {r["domain"]: r["n"] for r in counts.where(F.col("feature") < WORD_BUCKETS).groupBy("domain").agg(F.sum("n").alias("n")).collect()}
    everything = sum(sizes.values())
    shares = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = sum(shares.values())
    priors = [log((shares.get(d, 0) + SMOOTH) / (size + SMOOTH * len(domains))) for d in domains]
    wide = counts.groupBy("feature").agg(*(F.coalesce(F.sum(F.when(F.col("domain") == d, F.col("n"))), F.lit(0)).alias(f"n{k}") for k, d in enumerate(domains)))

    def table(first: int, features: int, key: str) -> DataFrame:
        rows = docs.sparkSession.range(features).select((F.col("id") + first).cast("int").alias("feature")).join(F.broadcast(wide), "feature", "left")
        n = [F.coalesce(F.col(f"n{k}"), F.lit(0)) for k in range(len(domains))]
        common = (sum(n[1:], n[0]) + SMOOTH) / (everything + SMOOTH * features)
        likely = [F.log((n[k] + SHRINK * features * common) / (sizes.get(d, 0) + SHRINK * features)) for k, d in enumerate(domains)]
        return rows.select((F.col("feature") - first).alias(key), *((likely[k] - likely[0]).alias(f"{key}{k}") for k in range(1, len(domains))))

    def values(rows: DataFrame, key: str) -> list[Column]:
        """For each other domain, the column as one array (fixed size), ordered by the key."""
        arrays = [F.array_sort(F.collect_list(F.struct(key, f"{key}{k}")))[f"{key}{k}"].alias(f"{key}{k}") for k in range(1, len(domains))]
        held = write_intermediate(rows.agg(*arrays), f"mixing-{key}s") if arrays else None
        return [held.select(f"{key}{k}").scalar() for k in range(1, len(domains))]

    return values(table(0, WORD_BUCKETS, "slot"), "slot"), values(table(WORD_BUCKETS, TAILS, "tail"), "tail"), priors


def posteriors(docs: DataFrame, labelled: DataFrame, domains: list[str]) -> DataFrame:
    """id, text_hash, n_tokens, p0, p1, ... (one per domain) of every unit.

    A text's words become numbers (slot and tail) and their log likelihoods
    are summed inside its row; no word is ever a row of its own.
    """
    slots, tails, priors = _model(docs, labelled, domains)
    words = F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), _SPLIT)
    features = F.transform(F.filter(words, lambda w: w != ""), lambda w: _slot(w) * TAILS + _tail(w))
    coded = docs.select("id", F.xxhash64("text").alias("text_hash"), features.alias("features"))
    # Columns of their own, since Spark takes no subquery inside a lambda function. As they and ``features`` are used
    # once, Spark puts them where they are used and no row holds the arrays.
    tables = [(f"{key}{k}", held) for key, arrays in (("slots", slots), ("tails", tails)) for k, held in enumerate(arrays, 1)]
    others = range(1, len(domains))

    def add(total: Column, f: Column) -> Column:
        one = lambda k: F.get(f"slots{k}", F.shiftright(f, 7)) + F.get(f"tails{k}", f.bitwiseAND(TAILS - 1))
        return F.struct((total["n"] + 1).alias("n"), *((total[f"s{k}"] + one(k)).alias(f"s{k}") for k in others))

    nothing = F.struct(F.lit(0).cast("long").alias("n"), *(F.lit(0.0).alias(f"s{k}") for k in others))
    summed = coded.select("*", *(held.alias(name) for name, held in tables)).select("id", "text_hash", F.aggregate("features", nothing, add).alias("sums"))
    rows = summed.select("id", "text_hash", "sums.*")
    repeated = rows.groupBy("id", "text_hash").agg(F.sum("n").alias("n_tokens"), *(F.sum(f"s{k}").alias(f"s{k}") for k in range(1, len(domains))))
    scale = F.pow(F.greatest(F.col("n_tokens"), F.lit(1)).cast("double"), F.lit(TEMPER))
    # log odds against the first domain
    sums = repeated.withColumn("s0", F.lit(0.0))
    logs = sums.select("id", "text_hash", "n_tokens", *((F.lit(priors[k]) + F.col(f"s{k}") * scale).alias(f"s{k}") for k in range(len(domains))))
    top = F.greatest(*(F.col(f"s{k}") for k in range(len(domains)))) if len(domains) > 1 else F.col("s0")
    odds = logs.select("id", "text_hash", "n_tokens", *(F.exp(F.col(f"s{k}") - top).alias(f"e{k}") for k in range(len(domains))))
    total = sum((F.col(f"e{k}") for k in range(1, len(domains))), F.col("e0"))
    return odds.select("id", "text_hash", "n_tokens", *((F.col(f"e{k}") / total).alias(f"p{k}") for k in range(len(domains))))


def _rate(start: Column, steps: list[list[float]]) -> Column:
    """The rate after these steps, from ``start``, kept in [0, MOST_RATE]."""
    rate = start
    for step in steps:
        move = sum((F.col(f"p{k}") * g for k, g in enumerate(step)), F.lit(0.0))
        rate = F.least(F.lit(MOST_RATE), F.greatest(F.lit(0.0), rate - move))
    return rate


def solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """``x`` with ``(matrix + a little of its mean diagonal) x = right``, by elimination (domains are few)."""
    n = len(right)
    ridge = RIDGE * (sum(matrix[k][k] for k in range(n)) / n or 1.0)
    rows = [[*(x + (ridge if i == j else 0.0) for j, x in enumerate(row)), right[i]] for i, row in enumerate(matrix)]
    for i in range(n):
        pivot = max(range(i, n), key=lambda r: abs(rows[r][i]))
        rows[i], rows[pivot] = rows[pivot], rows[i]
        for r in range(n):
            if r != i:
                factor = rows[r][i] / rows[i][i]
                rows[r] = [x - factor * y for x, y in zip(rows[r], rows[i], strict=True)]
    return [rows[i][n] / rows[i][i] for i in range(n)]


def fit_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> Mix:
    """Rates of all units of ``docs``; ``labelled`` has id and domain, ``targets`` the weight of each domain."""
    domains = sorted(targets)
    weight = sum(targets.values())
    if not domains or weight <= 0 or min(targets.values()) < 0:
        raise ValueError("targets are nonnegative weights, one at least above zero")
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    units = posteriors(own, labelled.select(F.col(id_col).alias("id"), "domain"), domains).withColumn("rate", F.lit(1.0))
    units = write_intermediate(units, "mixing-units")
    n = len(domains)
    # masses at rate 1, and how much one domain's mass moves when rates move along another's posteriors
    row = units.agg(
        *(F.sum(F.col("n_tokens") * F.col(f"p{k}")) for k in range(n)),
        *(F.sum(F.col("n_tokens") * F.col(f"p{j}") * F.col(f"p{k}")) for j in range(n) for k in range(n)),
    ).first()
    now = [x or 0.0 for x in row[:n]]
    gram = [[x or 0.0 for x in row[n + j * n : n + (j + 1) * n]] for j in range(n)]
    everything = sum(now)
    goal = [everything * targets[d] / weight for d in domains]
    taken, since, moved = 0, [], everything

    def gap(a: list[float], b: list[float]) -> float:
        return max(abs(x - y) for x, y in zip(a, b, strict=True))

    while everything and taken < MOST_STEPS and gap(now, goal) > TOLERANCE * everything and moved > TOLERANCE / 100 * everything:
        since.append(solve(gram, [a - b for a, b in zip(now, goal, strict=True)]))
        taken += 1
        if len(since) > STEPS_HELD:
            # the rate so far becomes a column, so its expression keeps a fixed size
            held = write_intermediate(units.withColumn("rate", _rate(F.col("rate"), since[:-1])), "mixing-units")
            discard(units)
            units, since = held, since[-1:]
        rate = _rate(F.col("rate"), since)
        row = units.agg(*(F.sum(rate * F.col("n_tokens") * F.col(f"p{k}")) for k in range(n))).first()
        before, now = now, [x or 0.0 for x in row]
        moved = gap(before, now)
    named = F.map_from_arrays(F.array(*(F.lit(d) for d in domains)), F.array(*(F.col(f"p{k}") for k in range(n))))
    rates = units.select("id", "text_hash", "n_tokens", named.alias("posteriors"), _rate(F.col("rate"), since).alias("rate"))
    size = sum(now)
    return Mix(rates, {d: x / size if size else 0.0 for d, x in zip(domains, now, strict=True)}, taken)


def copies(rate: Column, *key: Column) -> Column:
    """Whole copies with mean ``rate``, drawn by a hash of ``key``."""
    chance = F.pmod(F.xxhash64(*key, F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + chance).cast("int")


def take_copies(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each row as often as its rate says."""
    drawn = write_intermediate(
        mix.units.select("id", "text_hash", copies(F.col("rate"), F.col("id"), F.col("text_hash")).alias("n")), "mixing-copies"
    ).where("n > 0")
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").alias("own_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("own_hash"))
    same = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("text_hash"))
    return rows.join(drawn, same).select("row", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")
