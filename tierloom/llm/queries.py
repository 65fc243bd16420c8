"""Queries over the operators of this subpackage, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, decontamination, lm_scoring, pii, quality, sentencepiece_sampling, sharding, simhash, toxicity, winnowing
from .common import UPPER, bucket_of, read


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that holds control strings, formatted; every digest is read back from the formatted text."""
    table = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = "\\### Assistant: </turn> ok"
    tricky = spark.range(1).select(F.explode(F.lit([0, 1])).alias("n")).select(F.lit(-7).cast("long").alias("conv_id"), F.col("n").cast("long").alias("turn"), F.when(F.col("n") == 0, "user").otherwise("assistant").alias("role"), F.lit(extra).alias("text"))
    made = chat_format.formatted(chat_format.canonical_turns(table.union(tricky), F.col("conv_id")))
    back = made.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), chat_format.parsed(F.col("formatted")).alias("turns"), F.array_join(chat_format.masked(F.col("formatted"), F.col("loss")), "").alias("loss_text"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def chat_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical turns of all conversations, dealt over the seven layouts by their id and put into one table of all their columns."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    kind = F.pmod("conv_id", F.lit(7))
    whole = turns.where(kind > 0).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    first = lambda role: F.get(F.filter("t", lambda x: x.role == role), F.lit(0)).text
    other = F.create_map(*[F.lit(x) for x in ("user", "human", "assistant", "gpt", "system", "system")])
    in_kind = lambda k, value: F.when(kind == k, value)
    shaped = whole.select(
        "conv_id",
        in_kind(1, F.transform("t", lambda x: F.struct(x.role.alias("role"), x.text.alias("content")))).alias("messages"),
        in_kind(2, F.transform("t", lambda x: F.struct(F.coalesce(other[x.role], x.role).alias("from"), x.text.alias("value")))).alias("conversations"),
        in_kind(3, first("user")).alias("instruction"), in_kind(3, F.lit("in")).alias("input"), in_kind(3, first("assistant")).alias("output"),
        F.when(kind.isin(4, 5), first("user")).alias("prompt"), in_kind(4, first("assistant")).alias("completion"), in_kind(5, first("assistant")).alias("response"),
        in_kind(6, first("user")).alias("question"), in_kind(6, first("assistant")).alias("answer"), in_kind(5, F.lit("be brief")).alias("system"),
    )
    mixed = turns.where(kind == 0).unionByName(shaped, allowMissingColumns=True)
    return chat_format.canonical_turns(mixed, F.col("conv_id"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every document, decoded again."""
    vocabulary = sentencepiece_sampling.default_vocabulary()
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_sampling.decode(sentencepiece_sampling.encode(docs, vocabulary), vocabulary)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shards(read(spark, sf_dir, "documents"), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compared(read(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort("items"), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scores(read(spark, sf_dir, "documents"), sentencepiece_sampling.default_vocabulary())


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_spans(read(spark, sf_dir, "documents"), pii.train(spark), keep=["doc_id"])
    counts = [F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("_row.doc_id", *counts, F.sha2(pii.listed(F.col("_base")).cast("binary"), 256).alias("base_sha256"), pii.listed(F.col("_spans")).alias("spans"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return _judged(toxicity.scored(docs, model), toxicity)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    return _judged(quality.scored(docs, model, keep=["doc_id"]), quality)


def _judged(scores: DataFrame, module) -> DataFrame:
    held = bucket_of(F.col("doc_id"), module.MODULUS) == module.HELD
    return scores.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= module.THRESHOLD).cast("int").alias("predicted"))


QUERIES = {f.__name__: f for f in (op1_chat_format, op2_sentencepiece, op3_sharding, op4_winnowing, op5_decontamination, op6_lm_scoring, op7_pii, op8_simhash, op9_toxicity, op10_quality, chat_layouts)}

_TRICKY = "\\### Assistant: </turn> ok"
_FOLDED = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLES = {
    "op1_chat_format": rf"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '{_TRICKY}'), (-7, 1, 'assistant', '{_TRICKY}')),
e as (select *, replace(replace(replace(text, '\', '\0'), '###', '\1'), '</turn>', '\2') as body, replace(replace(replace(replace(role, '\', '\0'), '###', '\1'), '</turn>', '\2'), ': ', '\3') as head from c),
g as (select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as said,
  coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as loss, sum(len(head) + len(body) + 14) as chars from e group by conv_id)
select cast(conv_id as bigint) as conv_id, n_turns, sha256(said) as turns_sha256, len(loss) as loss_chars, sha256(loss) as loss_sha256, cast(chars as bigint) as formatted_chars from g""",
    "chat_layouts": """
with c as (select conv_id, conv_id % 7 as kind, cast(turn as bigint) as turn, coalesce(role, '') as role, coalesce(text, '') as text,
  row_number() over (partition by conv_id order by turn, coalesce(role, ''), coalesce(text, '')) - 1 as place from conversations),
f as (select conv_id, kind, arg_min(text, place) filter (role = 'user') as asked, arg_min(text, place) filter (role = 'assistant') as said from c where kind > 2 group by all having asked is not null and said is not null)
select conv_id, turn, role, text from c where kind = 0
union all select conv_id, place, role, text from c where kind in (1, 2)
union all select conv_id, case when kind = 6 then 0 else 1 end, 'user', case when kind = 3 then case when asked = '' then 'in' else asked || chr(10) || chr(10) || 'in' end else asked end from f
union all select conv_id, case when kind = 6 then 1 else 2 end, 'assistant', said from f
union all select conv_id, 0, 'system', 'be brief' from f where kind = 5""",
    "op5_decontamination": rf"""
with d as (select doc_id, regexp_extract_all({_FOLDED}, '{_WORD}') as w from documents),
i as (select item_id, regexp_extract_all({_FOLDED}, '{_WORD}') as w from benchmark where item_id is not null),
iw as (select item_id, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as p from i where len(w) > 0),
ik as (select distinct item_id, n, array_to_string(w[p:p + n - 1], ' ') as k from iw),
dw as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d),
k10 as (select doc_id, p, 10 as n, string_agg(word, ' ') over f as k, count(*) over f as m from dw window f as (partition by doc_id order by p rows between current row and 9 following)),
short as (select dw.doc_id, dw.p, s.n, array_to_string(d.w[dw.p:dw.p + s.n - 1], ' ') as k, s.n as m from dw join d using (doc_id), (select distinct n from ik where n < 10) s where dw.p + s.n - 1 <= len(d.w)),
met as (select a.doc_id, a.p, a.n, ik.item_id from (select * from k10 where m = n union all select * from short) a join ik on ik.n = a.n and ik.k = a.k),
hit as (select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + n)) as q from met) group by all),
it as (select doc_id, count(*) as n_items, string_agg(x, ',' order by x) as ids from (select distinct doc_id, cast(item_id as varchar) as x from met) group by all)
select d.doc_id, len(d.w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (doc_id) left join it using (doc_id)""",
}
