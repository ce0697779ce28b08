"""Registered queries opN_<name> and ``pipeline``: name -> callable, oracle."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.llm import ann, decontam, html, langid, packing, quality, simhash, spelling, substring, topk, toxicity, trie, warc
from sessionlab.llm.common import fold

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    return str(public_tokenizers.path("word_bpe_49k.json"))


@register("op1_warc")
def op1(spark, sf_dir):
    folder = warc.new_folder(spark)
    index = warc.write_bundles(_table(spark, sf_dir, "pages"), folder)
    return warc.read_bundles(index, folder).drop("url", "html")


@register("op2_packing")
def op2(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


@register("op3_toxicity")
def op3(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    return toxicity.predict(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


@register("op4_language_id")
def op4(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(fold(F.col("doc_id"), 3) != 1))
    return langid.predict(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


@register("op5_simhash")
def op5(spark, sf_dir):
    return simhash.near_dedup(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@register("op6_suffix_array")
def op6(spark, sf_dir):
    return substring.dedup(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register("op7_decontamination")
def op7(spark, sf_dir):
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@register("op8_quality")
def op8(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    train = fold(F.col("doc_id"), 5) != 0
    model = quality.fit(docs, labels.where(train), docs.where(train))
    return quality.predict(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


_TOPK_SQL = """
with w as (
  select vec_id, list_transform(embedding, lambda x: case when isfinite(x::double) then floor(256 * x::double) end) as x from embeddings
  where vec_id is not null and embedding is not null),
d as (
  select distinct vec_id, x from w where len(list_filter(x, lambda v: v is not null)) = len(x)),
r as (select row_number() over () as rid, vec_id, len(x) as n, x from d),
v as (select rid, vec_id, n, generate_subscripts(x, 1) as i, cast(unnest(x) as bigint) as x from r),
s as (
  select q.rid, q.vec_id as query_id, c.rid as cid, c.vec_id, cast(sum(q.x * c.x) as bigint) as score
  from v q join v c on q.i = c.i and q.n = c.n and c.vec_id <> q.vec_id
  where q.vec_id % 50 = 0 group by q.rid, q.vec_id, c.rid, c.vec_id),
t as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from t where rank <= 5
"""


@register("op9_topk", _TOPK_SQL)
def op9(spark, sf_dir):
    return topk.search(_table(spark, sf_dir, "embeddings"), query=lambda c: c % 50 == 0, k=5)


@register("op10_html")
def op10(spark, sf_dir):
    return html.extract(_table(spark, sf_dir, "pages"))


@register("op11_neighbours")
def op11(spark, sf_dir):
    return ann.search(_table(spark, sf_dir, "embeddings"), query=lambda c: c % 50 == 0, k=5)


_TRIE_SQL = """
with t as (
  select conv_id as c, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  where conv_id is not null),
o as (
  select c, list({'d': d, 'b': b} order by turn nulls first, d) as own
  from (select c, turn, sha256(length(role) || ':' || role || text) as d, cast(strlen(text) as bigint) as b from t) x
  group by c),
h as (
  select *, xor(list_reduce(
      list_concat([4294967295::bigint], list_transform(string_split(cast(c as varchar), ''), lambda x: ascii(x)::bigint)),
      lambda r, x: list_reduce(list_concat([xor(r, x)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
        lambda v, z: case when v & 1 = 1 then xor(v >> 1, 3988292384::bigint) else v >> 1 end)),
      4294967295::bigint) % 9 as h from o),
r as (
  select h.c, list_concat(coalesce(b.own[1:h], []), h.own[h + 1:]) as r
  from h left join o b on b.c = h.c - h.c % 5),
p as (select c, r, cast(unnest(range(0, len(r) + 1)) as bigint) as depth from r),
n as (
  select r[1:depth] as k, depth, min(c) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (where len(r) = depth), '')) as ends_sha256
  from p group by r[1:depth], depth),
kids as (select k[1:depth - 1] as k, depth - 1 as depth, count(*) as n_children from n where depth > 0 group by all),
e as (
  select n.*, coalesce(n_children, 0) as n_children,
         case when n.depth > 0 then (n_convs - 1) * n.k[n.depth].b else 0 end as saved
  from n left join kids on kids.k = n.k and kids.depth = n.depth),
above as (
  select k[1:up] as k, up as depth, count(*) filter (where n_children = 0) as n_leaves, sum(saved) as saved_tokens
  from (select *, cast(unnest(range(0, depth + 1)) as bigint) as up from e) x group by all)
select e.conv_id, e.depth, m.conv_id as parent_conv_id, e.n_convs, e.n_children, a.n_leaves,
       cast(a.saved_tokens as bigint) as saved_tokens, e.ends_sha256
from e join above a on a.k = e.k and a.depth = e.depth
left join n m on m.depth = e.depth - 1 and m.k = e.k[1:e.depth - 1]
"""


@register("op12_prefix_trie", _TRIE_SQL)
def op12(spark, sf_dir):
    return trie.trie(_table(spark, sf_dir, "conversations"))


@register("op13_spelling")
def op13(spark, sf_dir):
    return spelling.variants(_table(spark, sf_dir, "documents"))


@register("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLE)
