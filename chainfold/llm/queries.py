"""Registered queries of the text operators, with DuckDB SQL where SQL can express them.

Each query applies its operator to the whole table and derives the digest
columns of its contract from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainfold.llm import byte_bpe, chat, decontaminate, hard_negatives, html_text, mixing, ngram_join, pii, quality, search, substring_dedup, token_alignment, toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql.strip()
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@_query(
    rf"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents),
s as materialized (
  select distinct doc_id, shingle from (
    select doc_id, unnest(case when len(words) = 0 then []
      when len(words) < 3 then [array_to_string(words, ' ')]
      else list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')) end) as shingle from w)),
n as materialized (select doc_id, count(*) as n from s group by doc_id),
linked as materialized (
  select a.doc_id as u, b.doc_id as v from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id
  join n na on na.doc_id = a.doc_id join n nb on nb.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, na.n, nb.n having 100 * count(*) >= 90 * (na.n + nb.n - count(*))),
reach(doc_id, r) as (
  select doc_id, doc_id from documents
  union
  select reach.doc_id, linked.v from reach join linked on linked.u = reach.r)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.component_id
from documents d left join n using (doc_id)
join (select doc_id, min(r) as component_id from reach group by doc_id) c using (doc_id)
"""
)
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, num=90, den=100)


@_query(
    rf"""
with d as (select doc_id, {_WORDS} as words from documents),
g as materialized (
  select doc_id, words, unnest(range(1, len(words) - 11)) as p from d),
k as materialized (select doc_id, p, array_to_string(words[p:p + 12], ' ') as w from g),
m as materialized (select w, min(doc_id) as first_id from k group by w),
gone as (select distinct doc_id, unnest(range(p, p + 13)) as place from k join m using (w) where first_id < doc_id),
c as (select doc_id, count(*) as n, list(place) as places from gone group by doc_id)
select doc_id, len(words)::bigint as n_words, coalesce(c.n, 0)::bigint as n_removed,
  sha256(array_to_string(list_transform(list_filter(range(1, len(words) + 1),
    lambda i: not list_contains(coalesce(c.places, []), i)), lambda i: words[i]), ' ')) as kept_sha256
from d left join c using (doc_id)
"""
)
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), window=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@_query()
def op2_html_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


@_query()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = byte_bpe.encode(docs, RANK_FILE, public_tokenizers.PATTERN)
    return byte_bpe.decode(tokens, RANK_FILE).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: Weights of the mix: tokens of clean, junk and toxic text.
MIX_TARGETS = {"clean": 0.97, "junk": 0.02, "toxic": 0.01}
#: The same for documents that passed the quality rules, among which there is no junk to take from.
FILTERED_TARGETS = {"clean": 0.98, "toxic": 0.02}


def domain_labels(labels: DataFrame) -> DataFrame:
    """doc_id, domain of the labelled rows."""
    return labels.select(
        "doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "junk").when(F.col("quality") == 1, "clean").alias("domain")
    )


@_query()
def op5_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.fit_rates(_table(spark, sf_dir, "documents"), domain_labels(_table(spark, sf_dir, "labels")), MIX_TARGETS)
    return mix.units.select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        *(F.col("posteriors")[d].alias(f"p_{d}") for d in sorted(MIX_TARGETS)),
        "rate",
        mixing.copies(F.col("rate"), F.col("id"), F.col("text_hash")).alias("copies"),
    )


@_query(
    """
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
g as (
  select *, case when lag(role) over w = role then 1 else 0 end as goes_on,
    length(text) + length(text) - length(translate(text, '~[<', '')) as escaped
  from c window w as (partition by conv_id order by turn, role, text))
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(escaped + case role when 'system' then 5 when 'user' then 6 when 'assistant' then 5
        else 7 + length(role) + length(role) - length(translate(role, '~[<]+', '')) end
      + case when goes_on = 1 then 1
        else case role when 'system' then 6 when 'user' then 7 when 'assistant' then 4 else 7 end end)::bigint as formatted_chars
from g group by conv_id
"""
)
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    read = chat.format_chats(turns).select(
        "conv_id",
        F.length("formatted").cast("long").alias("formatted_chars"),
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss"),
    )
    line = F.transform("turns", lambda t: F.concat(t.getField("role"), F.lit("\n"), t.getField("text"), F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


@_query()
def op7_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.measure(docs).select("doc_id", "quality.*")


@_query()
def op8_toxicity_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), learn=~held_out)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


@_query(
    r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents where doc_id is not null),
stats as (select count(*)::double as n, avg(len(words))::double as mean from d),
t as materialized (select doc_id, word, count(*)::double as tf from (select doc_id, unnest(words) as word from d) group by all),
f as materialized (select word, count(*)::double as df from t group by word),
q as materialized (select distinct doc_id as query_id, word from t where doc_id % 100 = 0),
s as (
  select q.query_id, t.doc_id,
    round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d.words) / mean))), 6) as score
  from q join f using (word) join t using (word) join d on d.doc_id = t.doc_id cross join stats
  group by q.query_id, t.doc_id),
r as (select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from s)
select query_id, doc_id, score, rank::int as rank from r where rank <= 10
"""
)
def op9_bm25_block_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = search.top_k(search.build_index(docs), docs.where(F.col("doc_id") % 100 == 0), k=10)
    return found.withColumn("score", F.round("score", 6))


def _count(values: Column, value: str) -> Column:
    return F.size(F.filter(values, lambda v: v == value)).cast("long")


@_query()
def op10_pii_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))
    line = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s.getField("kind"), s.getField("start"), s.getField("end"))), ",")
    base = F.filter("spans", lambda s: s.getField("kind") != "term")
    base_line = F.array_join(F.transform(base, lambda s: F.concat_ws(":", s.getField("kind"), s.getField("start"), s.getField("end"))), ",")
    kinds = F.transform("spans", lambda s: s.getField("kind"))
    return found.select(
        "doc_id",
        *(_count(kinds, kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(base_line.cast("binary"), 256).alias("base_sha256"),
        line.alias("spans"),
    )


@_query(
    """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where label is not null and embedding is not null and vec_id is not null
    and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
s as materialized (
  select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id as other_id, list_dot_product(a.q, b.q)::bigint as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (
  select anchor_id, other_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select p.anchor_id, positive_id, row_number() over w::int as rank, other_id as negative_id, positive_score, score as negative_score
from p join s on p.anchor_id = s.anchor_id and not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window w as (partition by p.anchor_id, positive_id order by score desc, other_id)
qualify row_number() over w <= 10
"""
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    )
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


@_query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = token_alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") == 0, F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


@_query(
    r"""
with lower as (
  select 'd' as kind, doc_id as id, text from documents union all select 'i', item_id, text from benchmark),
w as materialized (
  select kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from lower),
i as (select id, words, least(10, len(words)) as n from w where kind = 'i' and len(words) > 0),
windows as materialized (
  select distinct id as item_id, n, array_to_string(words[p:p + n - 1], ' ') as gram
  from (select id, words, n, unnest(range(1, len(words) - n + 2)) as p from i)),
grams as (
  select doc_id, p, n, array_to_string(words[p:p + n - 1], ' ') as gram
  from (select id as doc_id, words, n, unnest(range(1, len(words) - n + 2)) as p
        from w cross join (select distinct n from i) where kind = 'd')),
met as materialized (select doc_id, p, n, item_id from grams join windows using (n, gram)),
hit as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(p, p + n)) as place from met) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item_id::varchar as item from met where item_id is not null) group by doc_id)
select w.id as doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated
from w left join hit on hit.doc_id = w.id left join items on items.doc_id = w.id where kind = 'd'
"""
)
def op13_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, _table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
