"""Recall tiers from keyword evidence and from classification codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.records import patent_id
from ..sources.taxonomy import TIERS, Taxonomy
from .matching import evidence


def rank(tier: Column) -> Column:
    """E, R, W, S as 0 to 3."""
    return F.array_position(F.lit(list(TIERS)), tier).cast("int") - 1


def tier_of(rank_: Column) -> Column:
    return F.get(F.lit(list(TIERS)), F.coalesce(rank_, F.lit(0)))


def highest_tier(tiers: Column) -> Column:
    """The highest of an array of tiers; E if it is empty."""
    return tier_of(F.array_max(F.transform(tiers, rank)))


def route_keywords(records: DataFrame, taxonomy: Taxonomy, fields: dict[str, str] | None = None) -> DataFrame:
    """`records` with keyword_hits, diagnostic_hits and keyword_level. Abstract and claim are read, each for itself; titles and codes are not."""
    return _routed(records, taxonomy, fields).drop("_e")


def _routed(records: DataFrame, taxonomy: Taxonomy, fields: dict[str, str] | None = None, plain: tuple[str, ...] = ()) -> DataFrame:
    """`route_keywords` with the evidence struct `_e`, which has the plain columns normalised."""
    fields = fields or {"abstract": "abstract", "claim": "claim"}
    found = records.withColumn("_e", evidence({n: F.col(c) for n, c in fields.items()}, taxonomy, map(F.col, plain)))
    found = found.select(*records.columns, "_e.keyword_hits", "_e.diagnostic_hits", "_e")
    return found.withColumn("keyword_level", highest_tier(F.col("keyword_hits.tier")))


def symbols(*columns: Column) -> Column:
    """Distinct classification symbols of several fields as (subclass, main_group, subgroup, original), in order of appearance.

    Equal symbols keep the first spelling. Fields come normalised (`normalize_text`) where they may hold full-width characters.
    """
    text = F.upper(F.concat_ws("\n\n", *columns))
    parts = F.regexp_extract_all(text, F.lit(r"([A-HY][0-9]{2}[A-Z]\s*[0-9]+\s*/\s*[0-9]+)"), F.lit(1))
    pattern = r"^([A-HY][0-9]{2}[A-Z])\s*([0-9]+)\s*/\s*([0-9]+)$"
    read = F.transform(parts, lambda p: F.struct(F.regexp_extract(p, pattern, 1).alias("subclass"), F.regexp_extract(p, pattern, 2).cast("int").alias("main_group"), F.regexp_extract(p, pattern, 3).alias("subgroup"), p.alias("original")))

    def fresh(all_: Column) -> Column:
        same = lambda a, b: (a.subclass == b.subclass) & (a.main_group == b.main_group) & (a.subgroup == b.subgroup)
        return F.filter(all_, lambda x, i: ~F.exists(F.slice(all_, F.lit(1), i), lambda y: same(x, y)))

    return F.element_at(F.transform(F.array(read), fresh), 1)


def symbol_text(s: Column) -> Column:
    return F.concat(s.subclass, F.lit(" "), s.main_group.cast("string"), F.lit("/"), s.subgroup)


def best_rules(codes: DataFrame, rules: DataFrame) -> DataFrame:
    """Codes (subclass, main_group, subgroup) joined with their most specific rule; codes without a rule drop out.

    A rule set is small and fixed, so Spark broadcasts it by its size; the equality on subclass and main group makes
    it a hash join either way.
    """
    keys = ["subclass", "main_group"]
    rule = rules.withColumnRenamed("subgroup", "rule_subgroup")
    fits = (F.col("match") == "exact") & (F.col("subgroup") == F.col("rule_subgroup")) | (F.col("match") != "exact") & (F.col("rule_subgroup").rlike("^0+$") | F.col("subgroup").startswith(F.col("rule_subgroup")))
    names = [c for c in codes.columns if c not in (*keys, "subgroup")]
    met = codes.join(rule, keys).where(fits)
    order = F.struct(F.col("specificity"), -F.col("position"))
    chosen = met.groupBy(*names, *keys, "subgroup").agg(F.max_by(F.struct("rule_id", "tier", "symbol", "match", "source_ids"), order).alias("rule"))
    return chosen.select(*names, *keys, "subgroup", "rule.*")


def ipc_hits(taxonomy: Taxonomy, codes: Column) -> Column:
    """Array of the most specific rule for each code of an array, resolved inside the row: the rule table is a constant."""
    kind = "array<struct<specificity:int,position:int,rule_id:string,tier:string,symbol:string,match:string,subclass:string,main_group:int,subgroup:string,source_ids:array<string>>>"
    rules = F.array(*[F.struct(F.lit(r["specificity"]).alias("specificity"), F.lit(-n).alias("position"), F.lit(r["id"]).alias("rule_id"), F.lit(r["tier"]).alias("tier"), F.lit(r["symbol"]).alias("symbol"), F.lit(r["match"]).alias("match"), F.lit(r["subclass"]).alias("subclass"), F.lit(r["main_group"]).alias("main_group"), F.lit(r["subgroup"]).alias("subgroup"), F.array(*map(F.lit, r.get("source_ids", []))).cast("array<string>").alias("source_ids")) for n, r in enumerate(taxonomy.rules)]).cast(kind)

    def fits(c: Column, r: Column) -> Column:
        deep = F.when(r.match == "exact", c.subgroup == r.subgroup).otherwise(r.subgroup.rlike("^0+$") | c.subgroup.startswith(r.subgroup))
        return (c.subclass == r.subclass) & (c.main_group == r.main_group) & deep

    def best(c: Column) -> Column:
        top = F.array_max(F.filter(rules, lambda r: fits(c, r)))
        return F.when(top.isNotNull(), F.struct(top.rule_id.alias("rule_id"), top.tier.alias("tier"), c.original.alias("original_symbol"), symbol_text(c).alias("normalized_symbol"), top.symbol.alias("rule_symbol"), top.source_ids.alias("source_ids")))

    return F.array_compact(F.transform(codes, best))


def route(records: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """Keyword routing plus classification codes: ipc_hits, normalized_ipc, ipc_level, and route_level, the higher of both."""
    routed = _routed(records, taxonomy, plain=("ipc", "main_ipc"))
    routed = routed.withColumn("_codes", symbols(*[F.get("_e.normalized", F.lit(i)) for i in range(2)])).drop("_e")
    routed = routed.withColumns({"ipc_hits": ipc_hits(taxonomy, F.col("_codes")), "normalized_ipc": F.transform("_codes", symbol_text)}).drop("_codes")
    routed = routed.withColumn("ipc_level", highest_tier(F.col("ipc_hits.tier")))
    return routed.withColumn("route_level", tier_of(F.greatest(rank(F.col("keyword_level")), rank(F.col("ipc_level")))))


def step1_rows(routed: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """The flat record of keyword routing: counts, scope modes and hits as compact JSON."""
    as_json = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    return routed.select(
        "dataset_id", patent_id().alias("patent_id"), "source_row_number", "application_year", "stock_code", "company_name", "industry", "market", "title", "keyword_level",
        F.size("keyword_hits").alias("keyword_hit_count"),
        F.aggregate("keyword_hits", F.lit(0), lambda n, h: n + F.size(h.context_hits)).alias("context_hit_count"),
        F.array_join(F.array_sort(F.array_distinct("keyword_hits.context_scope")), ";").alias("context_scope_modes"),
        as_json("keyword_hits").alias("keyword_hits"), as_json("diagnostic_hits").alias("diagnostic_hits"),
        F.lit(taxonomy.version).alias("taxonomy_version"),
    )


def route_statistics(routed: DataFrame) -> DataFrame:
    """One row for each dataset: records, tiers (all four, zero-filled), hit sums, scopes and missing fields."""
    count = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
    scopes = lambda mode: F.sum(F.size(F.filter("keyword_hits", lambda h: h.context_scope == mode))).cast("long")
    return routed.groupBy("dataset_id").agg(
        F.count("*").alias("records"), *[count(F.col("keyword_level") == t).alias(f"level_{t.lower()}") for t in reversed(TIERS)],
        F.sum(F.size("keyword_hits")).cast("long").alias("keyword_hits"),
        F.sum(F.aggregate("keyword_hits", F.lit(0), lambda n, h: n + F.size(h.context_hits))).cast("long").alias("context_hits"),
        scopes("sentence").alias("scope_sentence"), scopes("window").alias("scope_window"),
        F.sum(F.size("diagnostic_hits")).cast("long").alias("diagnostics"),
        count(F.coalesce(F.col("abstract"), F.lit("")) == "").alias("missing_abstract"), count(F.coalesce(F.col("claim"), F.lit("")) == "").alias("missing_claim"),
    )
