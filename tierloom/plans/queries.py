"""Queries over the driver's tables, each beside the SQL that says what it returns.

`documents` stand for records (first line as abstract, the rest as claim), `labels` for classifier results, `events` for
task states, `part` for classification codes, `orders` for strata.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import cell, digest, first_filled, normalize_text, scope_snippet, snippet, text_hash
from ..operators import classify, matching, metrics, routing, sampling, tasks
from ..operators.groups import with_group_size
from ..sources import records
from ..sources.taxonomy import Taxonomy, sample_taxonomy

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- records ---------------------------------------------------------------------------------------------------

CLAIM = "case when position(chr(10) in text) > 0 then substr(text, position(chr(10) in text) + 1) else '' end"
RECORDS = f"""records as (select doc_id, cast(doc_id + 2 as int) as source_row_number, source as dataset_id,
  split_part(text, chr(10), 1) as abstract, {CLAIM} as claim from documents)"""


def NORM(c):  # noqa: N802
    return rf"regexp_replace(regexp_replace(replace(lower({c}), 'ß', 'ss'), '[\t　 ]+', ' ', 'g'), '^\s+|\s+$', '', 'g')"


def as_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.instr("text", "\n")
    return table(spark, sf_dir, "documents").select(
        "doc_id", (F.col("doc_id") + 2).cast("int").alias("source_row_number"), F.col("source").alias("dataset_id"),
        F.substring_index("text", "\n", 1).alias("abstract"), F.when(at > 0, F.substring("text", at + 1, F.length("text"))).otherwise("").alias("claim"),
    )


def plain_taxonomy() -> Taxonomy:
    """The sample lexicon without its gated group."""
    whole = sample_taxonomy()
    return Taxonomy({**whole.docs, "term_groups": [g for g in whole.docs["term_groups"] if g["match_policy"]["mode"] != "cooccurrence"]}, whole.ipc)


WORDS = "apache license|mit license|license|ention|token|anon"
TIER = "case when k in ('apache license', 'license') then 3 when k in ('token', 'mit license') then 2 when k is not null then 1 end"
HITS = f"""{RECORDS}, hits as (
  select doc_id, 'abstract' as field, unnest(list_distinct(regexp_extract_all({NORM('abstract')}, '{WORDS}'))) as k from records
  union all select doc_id, 'claim', unnest(list_distinct(regexp_extract_all({NORM('claim')}, '{WORDS}'))) from records
), levels as (
  select r.doc_id, r.dataset_id, r.source_row_number, coalesce(max({TIER}), 0) as rank, count(k) as n from records r left join hits h using (doc_id) group by all
)"""
LEVEL = "case rank when 3 then 'S' when 2 then 'W' when 1 then 'R' else 'E' end"


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.route_keywords(as_records(spark, sf_dir), plain_taxonomy())


@query(f"with {HITS} select {LEVEL} as keyword_level, count(*) as n from levels group by all")
def tier_counts(spark, sf_dir):
    return routed(spark, sf_dir).groupBy("keyword_level").agg(F.count("*").alias("n"))


@query(f"with {HITS} select doc_id, {LEVEL} as keyword_level, n as keyword_hits from levels")
def route_documents(spark, sf_dir):
    return routed(spark, sf_dir).select("doc_id", "keyword_level", F.size("keyword_hits").cast("long").alias("keyword_hits"))


@query(f"with {HITS} select h.doc_id, h.field, h.k as keyword from hits h")
def keyword_evidence(spark, sf_dir):
    return matching.exploded_hits(routed(spark, sf_dir), ["doc_id"]).select("doc_id", "field", "keyword")


@query(f"""with s as (select doc_id, regexp_extract_all(lower(text), '{WORDS}') as m, string_split_regex(lower(text), '{WORDS}') as g from documents),
  i as (select doc_id, m, g, unnest(range(1, len(m) + 1)) as i from s)
select doc_id, m[i] as keyword, cast(list_sum(list_transform(g[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: len(x))), 0) as int) as start from i""")
def keyword_positions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("t"))
    spans = docs.where(F.col("t").rlike(WORDS)).select("doc_id", F.explode(matching.keyword_spans(F.col("t"), WORDS.split("|"))).alias("s"))
    return spans.select("doc_id", "s.keyword", "s.start")


MARKS = "。！？!?；;\n\r"
FIRST = f"""f as (select doc_id, lower(text) as t, position('license' in lower(text)) - 1 as a from documents where position('license' in lower(text)) > 0),
  p as (select *, a + 7 as b, len(regexp_replace(substr(t, 1, a), '[^{MARKS}]*$', '')) as l, len(regexp_extract(substr(t, a + 8), '^[^{MARKS}]*')) as r, regexp_matches(substr(t, a + 8), '[{MARKS}]') as later from f),
  q as (select *, case when l > 0 or later then l else greatest(a - 48, 0) end as low, case when l > 0 or later then b + r else least(len(t), b + 48) end as high, case when l > 0 or later then 'sentence' else 'window' end as mode from p)"""


def first_license(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("t"))
    found = docs.where(F.contains("t", F.lit("license"))).withColumn("a", F.instr("t", "license") - 1).withColumn("b", F.col("a") + 7)
    return found.withColumn("s", matching.scope(F.col("t"), F.col("a"), F.col("b"), 48))


@query(f"with {FIRST} select doc_id, cast(low as int) as scope_start, cast(high as int) as scope_end, mode from q")
def context_scope(spark, sf_dir):
    return first_license(spark, sf_dir).select("doc_id", F.col("s.start").alias("scope_start"), F.col("s.end").alias("scope_end"), F.col("s.mode").alias("mode"))


@query(f"""with {FIRST} select doc_id, replace(substr(t, greatest(a - 36, 0) + 1, least(len(t), b + 36) - greatest(a - 36, 0)), chr(10), ' ') as snippet,
  (case when greatest(low, a - 120) > low then '…' else '' end) || replace(substr(t, greatest(low, a - 120) + 1, least(high, b + 120) - greatest(low, a - 120)), chr(10), ' ') || (case when least(high, b + 120) < high then '…' else '' end) as context_snippet from q""")
def snippets(spark, sf_dir):
    t, a, b = F.col("t"), F.col("a"), F.col("b")
    return first_license(spark, sf_dir).select("doc_id", snippet(t, a, b).alias("snippet"), scope_snippet(t, F.col("s.start"), F.col("s.end"), a, b).alias("context_snippet"))


@query(f"""with {FIRST}, c as (select doc_id, a, b, low, unnest(regexp_extract_all(substr(t, low + 1, high - low), 'version|under')) as k from q)
select doc_id, k as keyword, count(*) as n from c group by all""")
def context_words(spark, sf_dir):
    part = F.substring("t", F.col("s.start") + 1, F.col("s.end") - F.col("s.start"))
    hits = first_license(spark, sf_dir).select("doc_id", F.explode(matching.keyword_spans(part, ["version", "under"])).alias("h"))
    return hits.groupBy("doc_id", "h.keyword").agg(F.count("*").alias("n"))


@query()
def context_evidence(spark, sf_dir):
    """Gated terms, contexts and distances: all hits with their context hits."""
    hits = matching.exploded_hits(routing.route_keywords(as_records(spark, sf_dir), sample_taxonomy()), ["doc_id"])
    return hits.select("doc_id", "field", "keyword", "context_scope", F.array_join("context_ids", ";").alias("context_ids"), F.explode_outer("context_hits").alias("c")).select("doc_id", "field", "keyword", "context_scope", "context_ids", "c.context_id", "c.start", "c.end", "c.distance")


@query(f"""with {RECORDS} select doc_id, len(list_distinct(regexp_extract_all({NORM('abstract')}, 'copyright|erin'))) + len(list_distinct(regexp_extract_all({NORM('claim')}, 'copyright|erin'))) as diagnostics from records""")
def diagnostics_only(spark, sf_dir):
    return routed(spark, sf_dir).select("doc_id", F.size("diagnostic_hits").cast("long").alias("diagnostics"))


@query(f"""with {HITS}, s as (select l.*, r.abstract, r.claim from levels l join records r using (doc_id))
select dataset_id, count(*) as records, count(*) filter (rank = 3) as level_s, count(*) filter (rank = 2) as level_w, count(*) filter (rank = 1) as level_r, count(*) filter (rank = 0) as level_e,
  cast(sum(n) as bigint) as keyword_hits, count(*) filter (abstract = '') as missing_abstract, count(*) filter (claim = '') as missing_claim from s group by all""")
def route_statistics(spark, sf_dir):
    return routing.route_statistics(routed(spark, sf_dir)).select("dataset_id", "records", "level_s", "level_w", "level_r", "level_e", "keyword_hits", "missing_abstract", "missing_claim")


@query(f"with {RECORDS} select doc_id, {NORM('claim')} as normalized from records")
def normalize(spark, sf_dir):
    return as_records(spark, sf_dir).select("doc_id", normalize_text(F.col("claim")).alias("normalized"))


# ---- classification codes --------------------------------------------------------------------------------------

IPC = r"select p_partkey, concat('g06f ', cast(p_partkey % 30 as varchar), '/', lpad(cast(p_size as varchar), 2, '0'), '; H04L 9/08') as ipc from part"
CODES = rf"""codes as (select p_partkey, unnest(list_distinct(regexp_extract_all(upper(ipc), '[A-HY][0-9]{{2}}[A-Z]\s*[0-9]+\s*/\s*[0-9]+'))) as c from ({IPC})),
  split as (select p_partkey, c[1:4] as subclass, cast(regexp_extract(c, '^....\s*([0-9]+)', 1) as int) as main_group, regexp_extract(c, '/\s*([0-9]+)$', 1) as subgroup from codes)"""
RULES = "rules(rule_id, tier, subclass, main_group, sub, exact, spec, pos) as (values ('I1','S','G06F',21,'60',true,3,0), ('I2','W','G06F',21,'00',false,0,1), ('I3','R','G06F',11,'00',false,0,2), ('I4','W','G06F',21,'30',false,2,3), ('I5','R','G06F',3,'06',false,4,4), ('I6','S','G06F',9,'4',false,2,5))"
BEST = f"""{CODES}, {RULES}, met as (select s.*, r.rule_id, r.tier, row_number() over (partition by p_partkey, subclass, main_group, subgroup order by spec desc, pos) as n
  from split s join rules r using (subclass, main_group) where case when exact then sub = subgroup else regexp_matches(sub, '^0+$') or starts_with(subgroup, sub) end)"""


def coded(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    text = F.concat(F.lit("g06f "), (F.col("p_partkey") % 30).cast("string"), F.lit("/"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit("; H04L 9/08"))
    return part.select("p_partkey", text.alias("ipc"))


@query(f"with {CODES} select p_partkey, subclass, main_group, subgroup from split")
def ipc_normalise(spark, sf_dir):
    return coded(spark, sf_dir).select("p_partkey", F.explode(routing.symbols(F.col("ipc"))).alias("c")).select("p_partkey", "c.subclass", "c.main_group", "c.subgroup")


@query(f"with {BEST} select p_partkey, subclass, main_group, subgroup, rule_id, tier from met where n = 1")
def ipc_best_rule(spark, sf_dir):
    return routing.best_rules(ipc_normalise(spark, sf_dir), sample_taxonomy().rule_frame(spark)).select("p_partkey", "subclass", "main_group", "subgroup", "rule_id", "tier")


@query(f"with {BEST} select p.p_partkey, case coalesce(max(case tier when 'S' then 3 when 'W' then 2 when 'R' then 1 end), 0) when 3 then 'S' when 2 then 'W' when 1 then 'R' else 'E' end as ipc_level from part p left join (select * from met where n = 1) m using (p_partkey) group by all")
def ipc_level(spark, sf_dir):
    hits = routing.ipc_hits(sample_taxonomy(), routing.symbols(F.col("ipc")))
    return coded(spark, sf_dir).select("p_partkey", routing.highest_tier(F.transform(hits, lambda h: h.tier)).alias("ipc_level"))


#: Fields in which the sample lexicon's gated term has an "on" (that is, any word of its context) in its scope.
GATED = f"""gated as (select distinct doc_id, field from (select doc_id, 'abstract' as field, {NORM('abstract')} as t from records union all select doc_id, 'claim', {NORM('claim')} from records)
  where case when regexp_matches(t, '[{MARKS}]') then len(list_filter(string_split_regex(t, '[{MARKS}]'), lambda x: contains(x, 'thnd') and contains(x, 'on'))) > 0 else regexp_matches(t, 'on.{{0,46}}thnd|thnd.{{0,46}}on') end)"""


@query(f"with {RECORDS}, {GATED} select doc_id, field from gated")
def gated_terms(spark, sf_dir):
    """Hits of the gated term: those with a context word in their sentence or window."""
    hits = matching.exploded_hits(routing.route_keywords(as_records(spark, sf_dir), sample_taxonomy()), ["doc_id"])
    return hits.where("keyword = 'thnd'").select("doc_id", "field")


def one_term() -> Taxonomy:
    """A single term with two contexts."""
    context = lambda i, word: {"id": i, "kind": "object", "keywords": [word], "source_ids": []}
    group = {"id": "S", "tier": "S", "keywords": ["license"], "source_ids": [], "match_policy": {"mode": "standalone_phrase"}}
    return Taxonomy({"taxonomy_version": "1", "term_groups": [group], "context_lexicons": [context("A", "version"), context("B", "under")]}, {"taxonomy_version": "1", "rules": []})


@query(f"""with {FIRST.replace("lower(text)", NORM("text"))},
  part as (select doc_id, mode, a, b, low, substr(t, low + 1, high - low) as x from q),
  c as (select doc_id, mode, a, b, low, 'A' as context_id, x, 'version' as word from part union all select doc_id, mode, a, b, low, 'B', x, 'under' from part),
  s as (select *, unnest(range(1, len(string_split(x, word)))) as i from c),
  h as (select doc_id, mode, context_id, a, b, low + cast(list_sum(list_transform(string_split(x, word)[1:i], lambda y: len(y))) as bigint) + (i - 1) * len(word) as start, len(word) as n from s)
select doc_id, mode as context_scope, context_id, count(*) as hits, cast(min(start) as int) as first_start, cast(min(greatest(start - b, a - start - n, 0)) as int) as least_distance from h group by all""")
def context_hits(spark, sf_dir):
    """Context words around the first hit of a term: how many, where the first is, how near the nearest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", matching.evidence({"text": F.col("text")}, one_term()).alias("e"))
    found = matching.exploded_hits(docs.select("doc_id", "e.keyword_hits"), ["doc_id"]).select("doc_id", "context_scope", F.explode("context_hits").alias("c"))
    return found.groupBy("doc_id", "context_scope", "c.context_id").agg(F.count("*").alias("hits"), F.min("c.start").alias("first_start"), F.min("c.distance").alias("least_distance"))


@query(f"""with {HITS}, {RULES}, {GATED}, k as (select l.doc_id, greatest(l.rank, case when exists (select 1 from gated g where g.doc_id = l.doc_id) then 1 else 0 end) as rank from levels l),
  c as (select doc_id, lpad(cast(doc_id % 70 as varchar), 2, '0') as subgroup from documents),
  met as (select c.doc_id, r.tier, row_number() over (partition by c.doc_id order by spec desc, pos) as n from c join rules r on r.subclass = 'G06F' and r.main_group = 21
    where case when exact then sub = subgroup else regexp_matches(sub, '^0+$') or starts_with(subgroup, sub) end),
  v as (select doc_id, subgroup, k.rank, coalesce(case m.tier when 'S' then 3 when 'W' then 2 when 'R' then 1 end, 0) as ipc from c join k using (doc_id) left join (select * from met where n = 1) m using (doc_id))
select doc_id, {LEVEL} as keyword_level, {LEVEL.replace("rank", "ipc")} as ipc_level, {LEVEL.replace("rank", "greatest(rank, ipc)")} as route_level, 'G06F 21/' || subgroup as normalized_ipc from v""")
def route_both(spark, sf_dir):
    """Keywords and codes together: the higher level of both."""
    rows = as_records(spark, sf_dir).withColumns({"ipc": F.concat(F.lit("G06F 21/"), F.lpad((F.col("doc_id") % 70).cast("string"), 2, "0")), "main_ipc": F.lit("")})
    return routing.route(rows, sample_taxonomy()).select("doc_id", "keyword_level", "ipc_level", "route_level", F.array_join("normalized_ipc", ";").alias("normalized_ipc"))


# ---- ingest ----------------------------------------------------------------------------------------------------


@query("select c_custkey, case when c_custkey % 3 = 0 then c_mktsegment when c_custkey % 3 = 1 then c_name else '' end as stock_code from customer")
def alias_coalesce(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    a = F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).when(F.col("c_custkey") % 3 == 1, "")
    b = F.when(F.col("c_custkey") % 3 == 1, F.col("c_name"))
    return c.select("c_custkey", first_filled(a, b).alias("stock_code"))


@query(r"""with r as (select c_custkey, chr(9) || ' ="  ' || c_name || ' "  ' as x from customer), s as (select c_custkey, regexp_replace(x, '^\s+|\s+$', '', 'g') as x from r) select c_custkey, regexp_replace(substr(x, 3, len(x) - 3), '^\s+|\s+$', '', 'g') as unwrapped from s""")
def cell_unwrap(spark, sf_dir):
    raw = F.concat(F.lit('\t ="  '), "c_name", F.lit(' "  '))
    return table(spark, sf_dir, "customer").select("c_custkey", cell(raw).alias("unwrapped"))


FILES = "select o_orderkey, case when o_orderkey % 3 = 0 then concat('/data/Set ', o_orderstatus, '_', year(o_orderdate), '.csv') when o_orderkey % 3 = 1 then concat('Big FILE (', o_orderpriority, ').csv') else concat('x1', year(o_orderdate), '9.csv') end as path from orders"


@query(rf"""with f as ({FILES}), s as (select o_orderkey, regexp_replace(regexp_replace(path, '^.*/', ''), '\.[^.]*$', '') as stem from f)
select o_orderkey, case when regexp_extract(stem, '(?:^|[^0-9])((?:19|20)[0-9]{{2}})(?:[^0-9]|$)', 1) <> '' then regexp_extract(stem, '(?:^|[^0-9])((?:19|20)[0-9]{{2}})(?:[^0-9]|$)', 1) else regexp_replace(regexp_replace(lower(stem), '[^\w]+', '-', 'g'), '^-+|-+$', '', 'g') end as dataset_id from s""")
def dataset_ids(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    year = F.year("o_orderdate").cast("string")
    path = F.when(k % 3 == 0, F.concat(F.lit("/data/Set "), "o_orderstatus", F.lit("_"), year, F.lit(".csv"))).when(k % 3 == 1, F.concat(F.lit("Big FILE ("), "o_orderpriority", F.lit(").csv"))).otherwise(F.concat(F.lit("x1"), year, F.lit("9.csv")))
    return o.select("o_orderkey", records.dataset_id_column(path).alias("dataset_id"))


@query("with f as (select distinct concat('dir', n_nationkey % 7, '/file_', 2000 + n_nationkey % 20, '.csv') as path, cast(2000 + n_nationkey % 20 as varchar) as d from nation) select d as dataset_id, array_to_string(list_sort(list(path)), ';') as paths from f group by d having count(*) > 1")
def dataset_collisions(spark, sf_dir):
    path = F.concat(F.lit("dir"), (F.col("n_nationkey") % 7).cast("string"), F.lit("/file_"), (2000 + F.col("n_nationkey") % 20).cast("string"), F.lit(".csv"))
    return records.collisions(table(spark, sf_dir, "nation").select(path.alias("path"))).select("dataset_id", F.array_join("paths", ";").alias("paths"))


@query("select s_suppkey, case when s_suppkey % 4 = 0 then s_name when s_suppkey % 4 = 1 then 'pub-' || s_suppkey when s_suppkey % 4 = 2 then 'gr-' || s_suppkey else 'source-row-' || (s_suppkey + 2) end as patent_id from supplier")
def patent_ids(spark, sf_dir):
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", (k + 2).alias("source_row_number"), F.when(k % 4 == 0, F.col("s_name")).alias("application_number"), F.when(k % 4 == 1, F.concat(F.lit("pub-"), k)).otherwise("").alias("publication_number"), F.when(k % 4 == 2, F.concat(F.lit("gr-"), k)).alias("grant_number"))
    return rows.select("s_suppkey", records.patent_id().alias("patent_id"))


@query(f"with {RECORDS} select doc_id, array_to_string(list_filter([case when abstract <> '' then '摘要：' || abstract end, case when claim <> '' then '主权项：' || claim end], lambda x: x is not null), chr(10)) as classification_text from records")
def classification_texts(spark, sf_dir):
    rows = as_records(spark, sf_dir).withColumns({"title": F.lit(""), "ipc": F.lit(None).cast("string"), "main_ipc": F.lit("")})
    return rows.select("doc_id", records.classification_text().alias("classification_text"))


# ---- tasks -----------------------------------------------------------------------------------------------------

#: Copies of a text are one patent; levels vary by row.
STEP1 = "step1 as (select doc_id, cast(doc_id + 2 as int) as source_row_number, lang as dataset_id, sha256(text) as patent_id, case doc_id % 11 when 0 then 'S' when 1 then 'W' when 2 then 'R' else 'E' end as keyword_level, case doc_id % 11 when 0 then 3 when 1 then 2 when 2 then 1 else 0 end as rank, text from documents)"
STRONG = f"{STEP1}, strong as (select * from (select *, row_number() over (partition by dataset_id, patent_id order by rank desc, source_row_number) as n from step1) where n = 1)"


def step1(spark, sf_dir):
    level = F.when(F.col("doc_id") % 11 == 0, "S").when(F.col("doc_id") % 11 == 1, "W").when(F.col("doc_id") % 11 == 2, "R").otherwise("E")
    return table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") + 2).cast("int").alias("source_row_number"), F.col("lang").alias("dataset_id"), F.sha2(F.col("text").cast("binary"), 256).alias("patent_id"), level.alias("keyword_level"))


@query(f"with {STRONG} select doc_id, dataset_id, patent_id, keyword_level from strong")
def precedence_dedupe(spark, sf_dir):
    return tasks.strongest(step1(spark, sf_dir)).select("doc_id", "dataset_id", "patent_id", "keyword_level")


@query(f"with {STRONG} select dataset_id, keyword_level, count(*) as unique_patents from strong group by all")
def unique_by_tier(spark, sf_dir):
    return tasks.population(step1(spark, sf_dir))


@query(f"with {STRONG} select doc_id, keyword_level, case when rank > 0 then keyword_level else 'E_sample' end as selection_group, case when rank > 0 then 1.0::double else 0.2::double end as selection_probability, case when rank > 0 then 1.0::double else 5.0::double end as sample_weight from strong where rank > 0 or cast(cast(concat('0x', substr(sha256(concat_ws('|', 'seed', dataset_id, patent_id)), 1, 13)) as bigint) as double) / 4503599627370496 < 0.2")
def select_tasks(spark, sf_dir):
    draw = tasks.uniform_sha("seed", F.col("dataset_id"), F.col("patent_id"))
    return tasks.select_tasks(step1(spark, sf_dir), 0.2, draw=draw).select("doc_id", "keyword_level", "selection_group", "selection_probability", "sample_weight")


@query("select doc_id, cast(cast(concat('0x', substr(sha256(concat_ws('|', 'seed', cast(doc_id as varchar))), 1, 13)) as bigint) as double) / 4503599627370496 as u from documents")
def stable_sample_sha(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tasks.uniform_sha("seed", F.col("doc_id")).alias("u"))


@query()
def stable_sample_blake(spark, sf_dir):
    rows = step1(spark, sf_dir)
    return rows.select("doc_id", tasks.uniform(tasks.SEED, F.col("dataset_id"), F.col("patent_id")).alias("u"), tasks.task_id(F.col("dataset_id"), F.col("patent_id")).alias("task_id"))


@query(f"with {STRONG} select s.doc_id, s.keyword_level, sha256(d.text) as payload_sha from strong s join documents d on d.lang = s.dataset_id and d.doc_id + 2 = s.source_row_number where rank > 0")
def payload_join(spark, sf_dir):
    chosen = tasks.strongest(step1(spark, sf_dir)).where("keyword_level <> 'E'").withColumns({"selection_group": F.col("keyword_level"), "selection_probability": F.lit(1.0), "sample_weight": F.lit(1.0)})
    docs = table(spark, sf_dir, "documents").select(F.col("lang").alias("dataset_id"), (F.col("doc_id") + 2).cast("int").alias("source_row_number"), F.lit("").alias("title"), F.lit("").alias("abstract"), F.col("text").alias("claim"), F.lit("").alias("ipc"), F.lit("").alias("main_ipc"))
    made = tasks.prepare_tasks(chosen, docs)
    body = F.from_json("payload_json", "claim string")["claim"]
    return made.select((F.col("source_row_number") - 2).cast("long").alias("doc_id"), "keyword_level", F.sha2(body.cast("binary"), 256).alias("payload_sha"))


STATE = "state as (select event_id, cast(event_id as varchar) as task_id, cast(user_id % 5 as varchar) as dataset_id, case event_id % 7 when 0 then 'failed' when 1 then 'pending' when 2 then 'running' else 'succeeded' end as status, cast(event_id % 4 as int) as attempts, value as elapsed_seconds, event_type as actual_model, case event_id % 4 when 0 then 'S' when 1 then 'W' when 2 then 'R' else 'E' end as keyword_level, case event_id % 4 when 0 then 0 when 1 then 1 when 2 then 2 else 3 end as o from events)"


def state(spark, sf_dir):
    k = F.col("event_id")
    pick = lambda n, *names: F.get(F.lit(list(names)), (k % n).cast("int"))
    return table(spark, sf_dir, "events").select(
        "event_id", k.cast("string").alias("task_id"), (F.col("user_id") % 5).cast("string").alias("dataset_id"), pick(7, "failed", "pending", "running", *["succeeded"] * 4).alias("status"),
        (k % 4).cast("int").alias("attempts"), F.col("value").alias("elapsed_seconds"), F.col("event_type").alias("actual_model"), pick(4, "S", "W", "R", "E").alias("keyword_level"), k.alias("source_row_number"),
    )


@query(f"""with {STATE}, s as (select dataset_id, count(*) as total, count(*) filter (status in ('succeeded', 'failed')) as completed, count(*) filter (status = 'succeeded') as succeeded, count(*) filter (status = 'failed') as failed, count(*) filter (status in ('pending', 'running')) as pending,
  cast(sum(attempts) as double) as att, sum(elapsed_seconds) as el, avg(elapsed_seconds) filter (status in ('succeeded', 'failed')) as t, array_to_string(list_sort(list(distinct actual_model)), ';') as actual_models from state group by all)
select dataset_id, total, completed, succeeded, failed, pending, actual_models, round(completed / total * 100, 4) as progress_percent, round(el / att, 3) as average_request_seconds, round(t, 3) as average_completed_task_seconds, round(pending * t / 4, 1) as eta_seconds from s""")
def task_progress(spark, sf_dir):
    return tasks.progress(state(spark, sf_dir), 4).withColumns({"actual_models": F.array_join("actual_models", ";"), "eta_seconds": F.round("eta_seconds", 1)})


@query(f"with {STATE} select task_id, keyword_level, attempts from state where status = 'pending' and attempts < 3 and event_id % 10 <> 8 order by o, event_id limit 100")
def task_claim_topk(spark, sf_dir):
    s = state(spark, sf_dir)
    return tasks.claim(s, 100, waiting=s.where("event_id % 10 = 8")).select("task_id", "keyword_level", "attempts")


@query(f"with {STATE} select task_id from state where status = 'pending' and attempts >= 3")
def stuck_tasks(spark, sf_dir):
    return tasks.stuck(state(spark, sf_dir)).select("task_id")


LOG = "log as (select cast(user_id as varchar) as task_id, cast(row_number() over (partition by user_id order by event_id) as int) as attempt, case when event_id % 3 = 0 then 'succeeded' else 'failed' end as status, round(value, 2) as elapsed_seconds, event_type as error from events)"


@query(f"""with {LOG}, last as (select task_id, max(attempt) as attempts, arg_max(status, attempt) as s, arg_max(error, attempt) as error, round(sum(elapsed_seconds), 4) as elapsed_seconds from log group by all)
select cast(c_custkey as varchar) as task_id, case when s = 'succeeded' then 'succeeded' when attempts >= 3 then 'failed' else 'pending' end as status, coalesce(attempts, 0) as attempts, coalesce(elapsed_seconds, 0) as elapsed_seconds, error from customer left join last on task_id = cast(c_custkey as varchar)""")
def latest_state(spark, sf_dir):
    from pyspark.sql.window import Window

    e = table(spark, sf_dir, "events")
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    log = e.select(F.col("user_id").cast("string").alias("task_id"), n.alias("attempt"), F.when(F.col("event_id") % 3 == 0, "succeeded").otherwise("failed").alias("status"), F.round("value", 2).alias("elapsed_seconds"), F.col("event_type").alias("error"))
    made = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("task_id"))
    return tasks.latest_state(made, log).select("task_id", "status", "attempts", F.round("elapsed_seconds", 4).alias("elapsed_seconds"), "error")


# ---- classifier results ----------------------------------------------------------------------------------------

ANSWER = """a as (select doc_id, toxic, quality, concat(case when doc_id % 2 = 0 then '```json' || chr(10) else '' end, '{"cat":', cat, ',"confidence":', case when doc_id % 17 = 0 then '1.5' else '0.9' end, ',"subtype":"', case when doc_id % 13 = 0 then 'other' when cat = 1 then 'data_integrity' when cat = 2 then 'potential_data_security' else 'other' end,
  '","core_invention":"c","evidence_chain":{"protected_object_or_activity":"p","security_goal_or_risk":"s","technical_mechanism":"t","causal_centrality":"c","missing_or_ambiguous_link":"', case when doc_id % 5 = 0 then 'link' else '' end, '"},"evidence":["e"],"reason":"r","review_flag":', case when cat = 2 then 'true' else 'false' end, ',"review_reason":"', case when doc_id % 3 = 0 then '' else 'why' end, '"}', case when doc_id % 2 = 0 then chr(10) || '```' else '' end) as raw, cat
  from (select *, case when toxic = 1 then 1 when quality = 0 then 2 else 3 end as cat from labels)),
  j as (select *, cast(regexp_extract(raw, '(?s)\\{.*\\}') as json) as r from a)""".replace("\\\\", "\\")


def answers(spark, sf_dir):
    cat = F.when(F.col("toxic") == 1, 1).when(F.col("quality") == 0, 2).otherwise(3)
    k, fence = F.col("doc_id"), F.col("doc_id") % 2 == 0
    raw = F.concat(
        F.when(fence, "```json\n").otherwise(""), F.lit('{"cat":'), cat.cast("string"), F.lit(',"confidence":'), F.when(k % 17 == 0, "1.5").otherwise("0.9"), F.lit(',"subtype":"'),
        F.when(k % 13 == 0, "other").when(cat == 1, "data_integrity").when(cat == 2, "potential_data_security").otherwise("other"),
        F.lit('","core_invention":"c","evidence_chain":{"protected_object_or_activity":"p","security_goal_or_risk":"s","technical_mechanism":"t","causal_centrality":"c","missing_or_ambiguous_link":"'), F.when(k % 5 == 0, "link").otherwise(""),
        F.lit('"},"evidence":["e"],"reason":"r","review_flag":'), F.when(cat == 2, "true").otherwise("false"), F.lit(',"review_reason":"'), F.when(k % 3 == 0, "").otherwise("why"), F.lit('"}'), F.when(fence, "\n```").otherwise(""),
    )
    return table(spark, sf_dir, "labels").select("doc_id", raw.alias("raw"))


@query(f"""with {ANSWER}, v as (select doc_id, list_filter([case when cast((r->>'confidence') as double) not between 0 and 1 then 'confidence' end,
  case when not ((cat = 1 and (r->>'subtype') = 'data_integrity') or (cat = 2 and (r->>'subtype') = 'potential_data_security') or (cat = 3 and (r->>'subtype') = 'other')) then 'subtype_for_cat' end,
  case when cat = 1 and (r->'evidence_chain'->>'missing_or_ambiguous_link') <> '' then 'cat1_open_link' end, case when cat = 2 and (r->'evidence_chain'->>'missing_or_ambiguous_link') = '' then 'cat2_no_link' end,
  case when (r->>'review_flag') = 'true' and (r->>'review_reason') = '' then 'review_without_reason' end], lambda x: x is not null) as broken from j) select doc_id, array_to_string(broken, ';') as violations from v""")
def validate_response(spark, sf_dir):
    return answers(spark, sf_dir).select("doc_id", F.array_join(classify.violations(classify.parsed(F.col("raw")), F.col("raw")), ";").alias("violations"))


@query(f"with {ANSWER} select cast(doc_id as varchar) as task_id, r->>'cat' as cat, r->>'subtype' as subtype, r->'evidence_chain'->>'technical_mechanism' as technical_mechanism, cast(r->'evidence' as varchar) as evidence, r->>'review_flag' as review_flag, r->>'review_reason' as review_reason from j")
def flatten_result(spark, sf_dir):
    blank = {c: F.lit("") for c in ("dataset_id", "patent_id", "keyword_level", "selection_group", "requested_model", "actual_model", "prompt_version", "response_id", "usage_json", "error", "finished_at")}
    rows = answers(spark, sf_dir).withColumns({"task_id": F.col("doc_id").cast("string"), "source_row_number": F.col("doc_id"), "status": F.lit("succeeded"), "attempts": F.lit(1), "selection_probability": F.lit(1.0), "sample_weight": F.lit(1.0), "elapsed_seconds": F.lit(1.0), "result_json": classify.json_object(F.col("raw")), **blank})
    return classify.results(rows).select("task_id", "cat", "subtype", "technical_mechanism", "evidence", "review_flag", "review_reason")


@query(f"with {RECORDS} select doc_id, substr(abstract, 1, 6000) as abstract, substr(claim, 1, 10000) as claim from records")
def json_payload(spark, sf_dir):
    rows = as_records(spark, sf_dir).withColumns({"title": F.lit(None).cast("string"), "ipc": F.lit(""), "main_ipc": F.lit("")})
    rows = rows.select("doc_id", classify.prompt(tasks.payload(), "do", "{}").alias("p"))
    body = F.from_json(F.regexp_extract("p", r"(?s)^do\n\n(.*)\n\n\{\}$", 1), "abstract string, claim string")
    return rows.select("doc_id", body["abstract"].alias("abstract"), body["claim"].alias("claim"))


@query("""with d as (select doc_id, text, case when len(coalesce(text, '')) % 2 = 1 then 1 else 3 end as cat, doc_id % 7 = 0 as busy, doc_id % 11 = 3 as odd from documents)
select cast(doc_id as varchar) as task_id, 1 as attempt, case when busy or odd then 'failed' else 'succeeded' end as status, case when not (busy or odd) then cast(cat as varchar) end as cat,
  case when busy then 'RuntimeError: busy' when odd then 'ValidationError: confidence' else '' end as error from d""")
def classified_tasks(spark, sf_dir):
    """A deterministic classifier run over all documents as tasks; it raises for some and breaks a rule for others."""
    import json

    def answer(payload: dict) -> dict:
        k = int(payload["main_ipc"])
        if k % 7 == 0:
            raise RuntimeError("busy")
        cat = 1 if len(payload["claim"]) % 2 else 3
        chain = dict.fromkeys(classify.CHAIN, "x") | {"missing_or_ambiguous_link": ""}
        return {"raw_text": json.dumps({"cat": cat, "confidence": 1.9 if k % 11 == 3 else 0.9, "subtype": "data_integrity" if cat == 1 else "other", "core_invention": "c", "evidence_chain": chain, "evidence": ["e"], "reason": "r", "review_flag": False, "review_reason": ""})}

    docs = table(spark, sf_dir, "documents")
    blank = F.lit("")
    rows = docs.select("doc_id", blank.alias("title"), blank.alias("abstract"), F.col("text").alias("claim"), blank.alias("ipc"), F.col("doc_id").cast("string").alias("main_ipc"))
    claimed = rows.select(F.col("doc_id").cast("string").alias("task_id"), tasks.payload().alias("payload_json"), F.lit(0).alias("attempts"))
    done = classify.run_classifier(claimed, answer, "fake")
    return done.select("task_id", "attempt", "status", F.get_json_object("result_json", "$.cat").alias("cat"), F.coalesce("error", blank).alias("error"))


# ---- sampling --------------------------------------------------------------------------------------------------

SHA = lambda *p: f"sha256(concat_ws('|', {', '.join(p)}))"
G0 = """g0 as (select doc_id, concat('task-', doc_id) as task_id, cast(2020 + doc_id % 3 as varchar) as year, case doc_id % 3 when 0 then 'S' when 1 then 'W' else 'R' end as keyword_level,
  case when toxic = 1 then 1 when quality = 0 then 2 else 3 end as cat, round(0.7 + 0.3 * (cast(cast(concat('0x', substr(sha256(cast(doc_id as varchar)), 1, 13)) as bigint) as double) / 4503599627370496), 6) as confidence,
  concat('sub', doc_id % 40) as subtype, case when doc_id % 17 = 0 then 2 else 1 end as attempts, doc_id % 23 = 0 as review_flag from labels),
 flags as (select g.*, list_filter([case when cat = 2 or review_flag then 'cat2_or_review' end, case when attempts > 1 then 'retry_success' end, case when count(*) over (partition by subtype) <= 10 then 'rare_subtype' end,
  case when cat = 3 and keyword_level in ('S', 'W') and confidence >= 0.9 then 'high_conflict' end, case when cat = 3 then 'swr_to_cat3' end], lambda x: x is not null) as f,
  case when confidence < 0.8 then 'lt_0.80' when confidence < 0.9 then '0.80_to_lt_0.90' when confidence < 0.98 then '0.90_to_lt_0.98' else '0.98_to_1.00' end as bin from g0 g),
 strata as (select *, coalesce(f[1], 'none') as risk_group, concat_ws('|', year, keyword_level, concat('cat', cat), bin) as base, concat_ws('|', year, keyword_level, concat('cat', cat), bin, coalesce(f[1], 'none')) as fine from flags)"""
CONFIG = sampling.SamplingConfig(target_size=300, core_size=200, seed="s1", rare_subtype_max=10)


def g0(spark, sf_dir):
    k = F.col("doc_id")
    u = F.conv(F.substring(F.sha2(k.cast("string").cast("binary"), 256), 1, 13), 16, 10).cast("double") / float(1 << 52)
    rows = table(spark, sf_dir, "labels").select(
        "doc_id", F.concat(F.lit("task-"), k).alias("task_id"), (2020 + k % 3).cast("string").alias("year"), F.get(F.lit(["S", "W", "R"]), (k % 3).cast("int")).alias("keyword_level"),
        F.when(F.col("toxic") == 1, 1).when(F.col("quality") == 0, 2).otherwise(3).alias("cat"), F.round(0.7 + 0.3 * u, 6).alias("confidence"),
        F.concat(F.lit("sub"), (k % 40).cast("string")).alias("subtype"), F.when(k % 17 == 0, 2).otherwise(1).alias("attempts"), (k % 23 == 0).alias("review_flag"),
    )
    return sampling.enrich(sampling.eligible(rows), CONFIG, with_text=False)


@query(f"with {G0} select doc_id, bin as confidence_bin, array_to_string(f, ';') as risk_flags, risk_group, concat(keyword_level, '_to_cat', cat) as transition_type, fine as sampling_stratum from strata")
def risk_flags(spark, sf_dir):
    return g0(spark, sf_dir).select("doc_id", "confidence_bin", F.array_join("risk_flags", ";").alias("risk_flags"), "risk_group", "transition_type", "sampling_stratum")


@query(f"with {G0} select fine as sampling_stratum, base as representative_stratum, count(*) as population from strata group by all")
def strata_counts(spark, sf_dir):
    return g0(spark, sf_dir).groupBy("sampling_stratum", "representative_stratum").agg(F.count("*").alias("population"))


@query(f"""with {G0}, c as (select base, fine, count(*) as n from strata group by all), q as (select *, cast(sum(n) over (partition by base) as bigint) // 2 as quota, sum(n) over (partition by base) as whole from c),
 i as (select *, cast(quota as double) * n / whole as ideal from q), o as (select *, row_number() over (partition by base order by ideal - floor(ideal) desc, fine) as k, quota - sum(floor(ideal)) over (partition by base) as spare from i)
select fine as sampling_stratum, cast(floor(ideal) + case when k <= spare then 1 else 0 end as bigint) as draws from o""")
def core_allocation(spark, sf_dir):
    counts = strata_counts(spark, sf_dir)
    from pyspark.sql.window import Window

    whole = F.sum("population").over(Window.partitionBy("representative_stratum"))
    quota = counts.withColumn("quota", F.floor(whole / 2).cast("double"))
    return sampling.proportional(quota, F.col("quota"), ["representative_stratum"], "sampling_stratum", "population").select("sampling_stratum", "draws")


@query()
def risk_allocation(spark, sf_dir):
    return sampling.allocations(g0(spark, sf_dir), CONFIG)


DRAW = f"""{G0}, n as (select fine, count(*) as pop, cast(ceil(count(*) / 3.0) as bigint) as m, cast(ceil(count(*) / 6.0) as bigint) as core from strata group by all),
 r as (select s.*, n.pop, n.m, n.core, row_number() over (partition by fine order by {SHA("'s1'", "'draw'", 'fine', 'task_id')}) as rank from strata s join n using (fine)), d as (select *, row_number() over (partition by fine order by {SHA("'s1'", "'phase'", 'fine', 'task_id')}) as phase from r where rank <= m)"""


def third(spark, sf_dir):
    """A fixed allocation: a third of each stratum, half of it as core."""
    counts = strata_counts(spark, sf_dir)
    m, core = F.ceil(F.col("population") / 3), F.ceil(F.col("population") / 6)
    return counts.select("sampling_stratum", "population", core.alias("core"), (m - core).alias("risk"), m.alias("sample"))


@query(f"with {DRAW} select concat('GOLD-', substr({SHA(chr(39) + 's1' + chr(39), chr(39) + 'sample-id' + chr(39), 'task_id')}, 1, 16)) as sample_id, task_id, cast(rank as int) as sample_rank_in_stratum, case when phase <= core then 'representative_core' else 'risk_addition' end as sample_stage, m / pop as inclusion_probability, 1 / (m / pop) as evaluation_weight from d")
def gold_draw(spark, sf_dir):
    drawn = sampling.draw(g0(spark, sf_dir), third(spark, sf_dir), CONFIG)
    return drawn.select("sample_id", "task_id", "sample_rank_in_stratum", "sample_stage", "inclusion_probability", "evaluation_weight")


@query(f"with {DRAW} select sample_stage, keyword_level, cat, risk_group, count(*) as n from (select *, case when phase <= core then 'representative_core' else 'risk_addition' end as sample_stage from d) group by grouping sets ((sample_stage), (keyword_level), (cat), (risk_group), (sample_stage, risk_group))")
def report_grouping_sets(spark, sf_dir):
    drawn = sampling.draw(g0(spark, sf_dir), third(spark, sf_dir), CONFIG)
    return sampling.distributions(drawn).select("sample_stage", "keyword_level", "cat", "risk_group", "n")


@query(f"select doc_id, cast(row_number() over (order by {SHA(chr(39) + 's1' + chr(39), chr(39) + 'annotator-order' + chr(39), chr(39) + 'A' + chr(39), 'cast(doc_id as varchar)')}) as int) as place from labels where toxic = 1")
def annotator_order(spark, sf_dir):
    """The annotator's order as places; a sample is small enough for one window."""
    from pyspark.sql.window import Window

    rows = table(spark, sf_dir, "labels").where("toxic = 1")
    order = digest(F.lit("s1"), F.lit("annotator-order"), F.lit("A"), F.col("doc_id"))
    return rows.select("doc_id", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(order)).alias("place"))


@query("with d as (select doc_id, sha256(text) as h from documents) select doc_id, h as text_hash, count(*) over (partition by h) as exact_text_group_size from d")
def text_group_size(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("text_hash"))
    return with_group_size(d, "text_hash", "exact_text_group_size")


@query(r"select doc_id, sha256(chr(10) || regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '^ | $', '', 'g') || chr(10)) as text_hash from documents")
def normalized_text_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text_hash(F.lit(""), F.col("text"), F.lit("")).alias("text_hash"))


# ---- evaluation ------------------------------------------------------------------------------------------------

PAIRS = "p as (select doc_id, toxic as truth, case when doc_id % 9 = 0 then 1 - toxic else toxic end as guess, quality as other, 1.0 + doc_id % 4 as w, doc_id % 3 as year from labels)"


def pairs(spark, sf_dir) -> DataFrame:
    k = F.col("doc_id")
    return table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("truth"), F.when(k % 9 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")).alias("guess"), F.col("quality").alias("other"), (1.0 + k % 4).alias("w"), (k % 3).alias("year"))


def r6(c: Column) -> Column:
    return F.round(c, 6)


@query(f"""with {PAIRS}, t as (select truth as class, sum(w) as t, sum(w) filter (truth = guess) as r from p group by all), g as (select guess as class, sum(w) as g from p group by all)
select class, round(r / g, 6) as precision, round(r / t, 6) as recall, round(2 * (r / g) * (r / t) / (r / g + r / t), 6) as f1 from t join g using (class)""")
def weighted_metrics(spark, sf_dir):
    m = metrics.class_metrics(pairs(spark, sf_dir), "truth", "guess", F.col("w"))
    return m.select("class", *[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")])


@query(f"with {PAIRS} select truth, guess, count(*) as n, cast(sum(w) as double) as weight from p group by all")
def confusion(spark, sf_dir):
    return metrics.confusion(pairs(spark, sf_dir), "truth", "guess", weight=F.col("w"))


@query(f"with {PAIRS} select year, count(*) as n, round(avg(case when truth <> guess then 1.0 else 0.0 end), 6) as error_rate from p group by all")
def error_profile(spark, sf_dir):
    return metrics.error_profile(pairs(spark, sf_dir), "truth", "guess", ("year",)).withColumn("error_rate", r6(F.col("error_rate")))


@query(f"""with {PAIRS}, s as (select count(*) as n, avg(case when truth = other then 1.0 else 0.0 end) as po, avg(truth) * avg(other) + (1 - avg(truth)) * (1 - avg(other)) as pe from p)
select n, round(po, 6) as agreement, round(1 - po, 6) as conflict_rate, round((po - pe) / (1 - pe), 6) as kappa from s""")
def kappa(spark, sf_dir):
    a = metrics.agreement(pairs(spark, sf_dir), "truth", "other")
    return a.select("n", *[r6(F.col(c)).alias(c) for c in ("agreement", "conflict_rate", "kappa")])


@query(f"with {PAIRS} select year, round(sum(w) * sum(w) / sum(w * w), 6) as n_eff from p group by all")
def effective_n(spark, sf_dir):
    return pairs(spark, sf_dir).groupBy("year").agg(r6(metrics.effective_n(F.col("w"))).alias("n_eff"))


@query(f"with {PAIRS}, c as (select count(*) filter (truth = guess and truth <> other) as only_a, count(*) filter (truth <> guess and truth = other) as only_b from p) select only_a, only_b, round(pow(greatest(abs(only_a - only_b) - 1, 0), 2) / (only_a + only_b), 6) as statistic from c")
def mcnemar(spark, sf_dir):
    m = metrics.mcnemar(pairs(spark, sf_dir), F.col("truth") == F.col("guess"), F.col("truth") == F.col("other"))
    return m.withColumn("statistic", r6(F.col("statistic")))


@query("""with u as (select doc_id, cast(cast(concat('0x', substr(sha256(concat_ws('|', 'split-v1', source)), 1, 13)) as bigint) as double) / 4503599627370496 as u from documents)
select doc_id, case when u < 0.6 then 'train' when u < 0.6::double + 0.2::double then 'dev' else 'test' end as part from u""")
def grouped_split(spark, sf_dir):
    return metrics.grouped_split(table(spark, sf_dir, "documents"), "source", {"train": 0.6, "dev": 0.2, "test": 0.2}).select("doc_id", "part")


@query("select doc_id from labels where doc_id not in (select doc_id from labels where toxic = 1)")
def without_leaks(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").withColumn("patent_id", F.col("doc_id"))
    return metrics.without_leaks(rows, rows.where("toxic = 1"), ("patent_id",)).select("doc_id")


@query("""select coalesce(a.doc_id, b.doc_id) as sample_id, case when a.toxic is null or b.quality is null then 'missing' when a.toxic <> b.quality then 'category_conflict' end as conflict_type
from (select * from labels where doc_id % 2 = 0 or doc_id % 3 = 0) a full outer join (select * from labels where doc_id % 5 <> 0) b on a.doc_id = b.doc_id""")
def adjudication(spark, sf_dir):
    rows = table(spark, sf_dir, "labels")
    side = lambda where, c: rows.where(where).select(F.col("doc_id").alias("sample_id"), F.col(c).alias("human_cat"), F.lit("resolved").alias("human_review_state"))
    return metrics.merged_annotations(side("doc_id % 2 = 0 or doc_id % 3 = 0", "toxic"), side("doc_id % 5 <> 0", "quality")).select("sample_id", "conflict_type")


POISSON = [sum(1 / (math.e * math.factorial(j)) for j in range(k + 1)) for k in range(8)]


@query(f"""with {PAIRS}, r as (select cast(replicate as int) as replicate, p.*, cast(cast(concat('0x', substr(sha256(concat_ws('|', 'bootstrap-v1', cast(replicate as varchar), cast(doc_id as varchar))), 1, 13)) as bigint) as double) / 4503599627370496 as u from p, range(1, 101) t(replicate)),
  w as (select *, {" + ".join(f"case when u >= {x!r} then 1 else 0 end" for x in POISSON)} as times from r)
select replicate, round(sum(times * (case when truth = guess then 1.0 else 0.0 end - case when truth = other then 1.0 else 0.0 end)) / sum(times), 6) as difference from w group by all""")
def paired_bootstrap(spark, sf_dir):
    p = pairs(spark, sf_dir)
    right = lambda c: F.when(F.col("truth") == F.col(c), 1.0).otherwise(0.0)
    return metrics.paired_bootstrap(p, "doc_id", right("guess"), right("other"), 100).select("replicate", r6(F.col("difference")).alias("difference"))


# ---- streaming -------------------------------------------------------------------------------------------------


@query("select epoch_ms(time_bucket(interval '5 minutes', ts)) // 1000 as window_start, case when event_id % 3 = 0 then 'succeeded' else 'failed' end as status, count(*) as attempts, round(sum(value), 4) as seconds from events group by all")
def attempt_windows(spark, sf_dir):
    """The attempts log as a stream, caught up with: attempts by five-minute window and status."""
    import uuid

    from ..streaming.task_log import progress_stream

    source = table(spark, sf_dir, "events")
    log = spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    log = log.select(F.col("ts").cast("string").alias("finished_at"), F.when(F.col("event_id") % 3 == 0, "succeeded").otherwise("failed").alias("status"), F.col("value").alias("elapsed_seconds"))
    name = f"windows_{uuid.uuid4().hex}"
    run = progress_stream(log).writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.table(name).select(F.unix_timestamp("window.start").alias("window_start"), "status", "attempts", F.round("seconds", 4).alias("seconds"))
