"""The registered queries of the operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import session
from tidelog.llm import (
    chat, collocations, decontaminate, divergence, html_text, licenses, minhash, packing, prefix_tokens, repair, repeats,
    sharding, token_files,
)
from tidelog.llm.common import BATCH_BYTES, ready, table

SHINGLE_WORDS = 2
REPEATED_BYTES = 200


def op1_differencing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), shards=40)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                        kind="words", end_id=1, capacity=4096)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("places")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = session.scratch(spark, "token-store")
    token_files.write_store(table(spark, sf_dir, "documents"), store,
                            public_tokenizers.path("byte_bpe_50k.json"), kind="bytes", end_id=0)
    return token_files.read_store(spark, store)


def op5_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.score(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=SHINGLE_WORDS)


def op9_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    kinds = {f.name: f.dataType for f in rows.schema}
    extra = spark.range(2).select(F.lit(-7).cast(kinds["conv_id"]).alias("conv_id"),
                                  F.col("id").cast(kinds["turn"]).alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  said.alias("text"))
    return chat.digests(rows.unionByName(extra))


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"), min_bytes=REPEATED_BYTES)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tokens.prefix_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")).drop("prefix")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair.repair(repair.damaged(table(spark, sf_dir, "conversations")))
    return found.withColumnRenamed("conv", "conv_id")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark, BATCH_BYTES)
    return collocations.collocations(table(spark, sf_dir, "documents"))


LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6_SQL = rf"""
with d as (
    select doc_id, regexp_extract_all({LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
i as (
    select item_id, regexp_extract_all({LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark where item_id is not null),
item_windows as (
    select distinct item_id, least(13, len(w)) as l, array_to_string(w[k:k + least(13, len(w)) - 1], ' ') as t
    from i, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as x(k) where len(w) > 0),
lengths as (select distinct l from item_windows),
places as (
    select distinct doc_id, k, lengths.l, array_to_string(w[k:k + lengths.l - 1], ' ') as t
    from d, lengths, unnest(range(1, len(w) - lengths.l + 2)) as x(k) where len(w) >= lengths.l),
found as (select doc_id, k, p.l, item_id from places p join item_windows v on p.l = v.l and p.t = v.t),
hits as (
    select doc_id, count(distinct j) as n from found, unnest(range(k, k + l)) as x(j) group by doc_id),
items as (
    select doc_id, count(*) as n, string_agg(s, ',' order by s) as s
    from (select distinct doc_id, cast(item_id as varchar) as s from found) group by doc_id)
select d.doc_id, coalesce(len(w), 0) as n_words, coalesce(hits.n, 0) as n_hit, coalesce(items.n, 0) as n_items,
    sha256(coalesce(items.s, '')) as items_sha256,
    coalesce(hits.n, 0) > 0 and 20 * coalesce(hits.n, 0) >= coalesce(len(w), 0) as contaminated
from d left join hits on d.doc_id = hits.doc_id left join items on d.doc_id = items.doc_id
"""

OP8_SQL = rf"""
with recursive d as (
    select doc_id, regexp_extract_all({LOW}, '[^\x20\x09-\x0D]+') as w from documents),
s as (
    select distinct doc_id, case when len(w) = 1 then w[1] else w[k] || ' ' || w[k + 1] end as t
    from d, unnest(range(1, greatest(len(w) - 1, 1) + 1)) as x(k) where len(w) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
common as (
    select a.doc_id as x, b.doc_id as y, count(*) as c
    from s a join s b on a.t = b.t and a.doc_id < b.doc_id group by all),
links as (
    select x, y from common join n p on p.doc_id = x join n q on q.doc_id = y
    where 100 * c >= 80 * (p.n + q.n - c)),
edges as (select x, y from links union select y, x from links),
reach as (
    select doc_id as x, doc_id as y from d
    union
    select reach.x, edges.y from reach join edges on reach.y = edges.x)
select d.doc_id, coalesce(n.n, 0) as n_shingles, m.component_id, d.doc_id = m.component_id as kept
from d left join n on d.doc_id = n.doc_id
join (select x, min(y) as component_id from reach group by x) m on m.x = d.doc_id
"""

OP9_SQL = r"""
with said as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (
    select *, length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g'))
        + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) as n from said)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
    sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text)) as loss_sha256,
    cast(3 + sum(n + length('[INST][/INST]</s>')) as bigint) as formatted_chars
from e group by conv_id
"""

OP13_SQL = rf"""
with d as (
    select row_number() over () as id, coalesce(lang, 'und') as lang,
        regexp_split_to_array({LOW}, '[.,;:!?\x0A-\x0D]') as pieces
    from documents where text is not null),
p as (select id, lang, unnest(pieces) as piece, generate_subscripts(pieces, 1) as k from d),
v as (select id, lang, k, regexp_extract_all(piece, '[^\x20\x09]+') as v from p),
w as (select id, lang, k, unnest(v) as w, generate_subscripts(v, 1) as j from v),
places as (
    select lang, w as w1, lead(w, 1) over q as w2, lead(w, 2) over q as w3, lead(w, 3) over q as w4
    from w window q as (partition by id, k order by j)),
grams as (
    select lang, 1 as size, w1 as phrase, count(*) as f from places group by all
    union all select lang, 2, w1 || ' ' || w2, count(*) from places where w2 is not null group by all
    union all select lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) from places where w3 is not null group by all
    union all select lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*)
        from places where w4 is not null group by all),
n as (select lang, sum(f) as n from grams where size = 1 group by lang),
c as (select *, string_split(phrase, ' ') as v from grams where size > 1 and f >= 30),
cuts as (
    select c.lang, c.size, c.phrase, c.f as a, k, p.f as l, q.f as r,
        cast(cast(2000000 as hugeint) * c.f // (p.f + q.f) as bigint) as score
    from c, unnest(range(1, c.size)) as x(k), grams p, grams q
    where p.lang = c.lang and p.size = k and p.phrase = array_to_string(c.v[1:k], ' ')
        and q.lang = c.lang and q.size = c.size - k and q.phrase = array_to_string(c.v[k + 1:], ' ')),
rated as (
    select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
parts as (
    select c.lang, size as s, array_to_string(v[i:i + s2 - 1], ' ') as part, c.f as longer
    from c, unnest(range(2, c.size)) as x(s2), unnest(range(1, c.size - s2 + 2)) as y(i)),
gone as (
    select distinct r.lang, r.phrase from rated r join parts p on p.lang = r.lang and p.part = r.phrase
    where 100 * cast(p.longer as hugeint) >= 80 * cast(r.a as hugeint)),
ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
    from rated anti join gone using (lang, phrase))
select lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l,
    cast(r as bigint) as r, cast(n as bigint) as n, score
from ranked join n using (lang) where rank <= 2000
"""

_RUNS = (
    op1_differencing_shards, op2_best_fit_packing, op3_license_scan, op4_token_files,
    op5_distribution_divergence, op6_decontamination, op7_main_text, op8_near_duplicates, op9_reply_trees,
    op10_repeated_passages, op11_prefix_token_counts, op12_conversation_repair, op13_collocations,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def prepared(run):
        return lambda spark, sf_dir: run(ready(spark), sf_dir)

    return {run.__name__: prepared(run) for run in _RUNS}


def oracle_sql() -> dict[str, str]:
    return {"op6_decontamination": OP6_SQL, "op8_near_duplicates": OP8_SQL, "op9_reply_trees": OP9_SQL,
            "op13_collocations": OP13_SQL}
