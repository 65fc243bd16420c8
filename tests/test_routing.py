import json
import re
import threading
import tracemalloc
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierloom.operators import matching, routing
from tierloom.plans.queries import QUERIES
from tierloom.sources.taxonomy import Taxonomy

G = lambda i, tier, words, **policy: {"id": i, "tier": tier, "keywords": words, "source_ids": ["A"], "match_policy": {"mode": "standalone_phrase"} | policy}
DOCS = {
    "taxonomy_version": "t", "normalization": {"context_window_chars": 48},
    "term_groups": [G("S1", "S", ["数据安全", "安全聚合"]), G("W1", "W", ["数据安全审计", "隐私安全", "Audit Log"]), G("R1", "R", ["加密"]), G("W2", "W", ["零知识证明"], mode="cooccurrence", required_any=["OBJ", "GOAL"]), G("E1", "E", ["方法"])],
    "context_lexicons": [{"id": "OBJ", "kind": "object", "keywords": ["数据", "用户数据"], "source_ids": ["B"]}, {"id": "GOAL", "kind": "goal", "keywords": ["泄露"], "source_ids": ["C"]}],
    "diagnostic_patterns": [{"id": "D1", "kind": "n", "keywords": ["安全生产"], "effect": "record_only"}],
}
R = lambda i, tier, symbol, match="subtree": {"id": i, "tier": tier, "symbol": symbol, "match": match, "source_ids": ["A"]}
IPC = {"taxonomy_version": "i", "rules": [R("r0", "W", "G06F 21/00"), R("r1", "S", "G06F 21/60", "exact"), R("r2", "S", "G06F 21/62"), R("r3", "W", "G06F 21/30"), R("r4", "R", "H04W 12/02")]}
TAXONOMY = Taxonomy(DOCS, IPC)
FIELDS = "id int, title string, abstract string, claim string, ipc string, main_ipc string"


def route(spark, *rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], FIELDS)
    return routing.route(df, TAXONOMY).orderBy("id").collect()


def hit(spark, abstract, claim="", title="", ipc="", main=""):
    return route(spark, (title, abstract, claim, ipc, main))[0]


@settings(max_examples=200, deadline=None)
@given(st.text("ab数据", max_size=30), st.lists(st.text("ab数据", min_size=1, max_size=4), max_size=6))
def test_automaton_equals_a_longest_first_alternation(text, words):
    m = matching.Matcher(words)
    pattern = re.compile("|".join(map(re.escape, sorted(m.keywords, key=len, reverse=True))) or r"(?!)")
    assert m.spans(text) == [x.span() for x in pattern.finditer(text)]
    m.automaton = None
    assert m.spans(text) == [x.span() for x in pattern.finditer(text)]


def test_longest_match_can_lower_a_tier(spark):
    r = hit(spark, "一种数据安全审计装置")
    assert r.keyword_level == "W" and [h.keyword for h in r.keyword_hits] == ["数据安全审计"]


def test_an_earlier_match_masks_a_higher_one(spark):
    assert [h.keyword for h in hit(spark, "隐私安全聚合").keyword_hits] == ["隐私安全"]


def test_gated_term_needs_context(spark):
    alone, with_object, gated_later = route(spark, ("", "零知识证明电路", "", "", ""), ("", "用户数据的零知识证明", "", "", ""), ("", "零知识证明电路。数据零知识证明", "", "", ""))
    assert alone.keyword_level == "E" and not alone.keyword_hits
    h = with_object.keyword_hits[0]
    assert h.context_ids == ["OBJ"] and h.context_scope == "window" and h.context_hits[0].keyword == "用户数据" and h.context_hits[0].distance == 1
    assert gated_later.keyword_level == "W" and gated_later.keyword_hits[0].context_scope == "sentence"


def test_sentence_and_window_scopes(spark):
    far, near, sentence, other = route(
        spark, ("", "零知识证明" + "甲" * 60 + "数据", "", "", ""), ("", "零知识证明" + "甲" * 40 + "数据", "", "", ""), ("", "零知识证明" + "甲" * 60 + "数据。", "", "", ""), ("", "数据。零知识证明" + "甲" * 60, "", "", "")
    )
    assert [far.keyword_level, near.keyword_level, sentence.keyword_level, other.keyword_level] == ["E", "W", "W", "E"]


def test_standalone_terms_keep_context(spark):
    h = hit(spark, "防止泄露的加密").keyword_hits[0]
    assert h.context_ids == [] and [c.context_id for c in h.context_hits] == ["GOAL"]


def test_diagnostics_do_not_lower(spark):
    r = hit(spark, "安全生产中的数据安全")
    assert r.keyword_level == "S" and [d.keyword for d in r.diagnostic_hits] == ["安全生产"]


def test_titles_do_not_route_but_claims_do(spark):
    assert hit(spark, "", title="数据安全").keyword_level == "E"
    r = hit(spark, "", claim="数据安全 数据安全")
    assert r.keyword_level == "S" and len(r.keyword_hits) == 1 and r.keyword_hits[0].field == "claim"


def test_latin_keywords_fold_and_need_no_boundary(spark):
    assert [h.keyword for h in hit(spark, "xＡＵＤＩＴ　Logs").keyword_hits] == ["audit log"]


def test_snippets_are_clipped_with_dots(spark):
    h = hit(spark, "甲" * 200 + "加密" + "乙" * 200 + "。").keyword_hits[0]
    assert h.snippet == "甲" * 36 + "加密" + "乙" * 36
    assert h.context_snippet == "…" + "甲" * 120 + "加密" + "乙" * 120 + "…"


def test_codes_take_their_most_specific_rule(spark):
    r = hit(spark, "", ipc="g06f 021/60; Ｇ０６Ｆ21/602;G06F 21 / 31", main="G06F 21/60")
    assert [(h.normalized_symbol, h.rule_id) for h in r.ipc_hits] == [("G06F 21/60", "r1"), ("G06F 21/602", "r0"), ("G06F 21/31", "r0")]
    assert r.ipc_level == "S" and r.route_level == "S" and r.normalized_ipc == ["G06F 21/60", "G06F 21/602", "G06F 21/31"]
    assert r.ipc_hits[0].original_symbol == "G06F 021/60"
    deep, none = route(spark, ("", "加密", "", "G06F 21/6245 H04W 12/02", ""), ("", "", "", "A01B 1/00", ""))
    assert [h.rule_id for h in deep.ipc_hits] == ["r2", "r4"] and deep.route_level == "S" and deep.keyword_level == "R"
    assert none.ipc_level == "E" and not none.ipc_hits and none.normalized_ipc == ["A01B 1/00"]


def test_join_form_agrees_with_the_row_form(spark):
    df = spark.createDataFrame([(i, f"G06F 21/{n}") for i, n in enumerate(["60", "602", "31", "30", "301", "62", "6", "00"])], "id int, ipc string")
    codes = df.select("id", F.explode(routing.symbols(F.col("ipc"))).alias("c")).select("id", "c.subclass", "c.main_group", "c.subgroup")
    joined = {r.id: r.rule_id for r in routing.best_rules(codes, TAXONOMY.rule_frame(spark)).collect()}
    inside = {r.id: r.h[0].rule_id for r in df.select("id", routing.ipc_hits(TAXONOMY, routing.symbols(F.col("ipc"))).alias("h")).where("size(h) > 0").collect()}
    assert joined == inside


def test_native_spans_agree_with_the_automaton(spark):
    words = ["数据", "数据安全", "a.b", "x"]
    texts = ["", "数据安全a.b数据x", "axb数据", "x" * 50, "a.b\n数据😀x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").select("id", matching.keyword_spans(F.col("t"), words).alias("s"))
    m = matching.Matcher(words)
    for r in df.collect():
        assert [(x.keyword, x.start) for x in r.s] == [(texts[r.id][a:b], a) for a, b in m.spans(texts[r.id])]


def test_native_scope_agrees(spark):
    texts = ["甲" * 60 + "加密" + "乙" * 60, "一。二加密三", "加密。", "！加密", "a\n加密b\nc"]
    rows = [(i, t, t.index("加密")) for i, t in enumerate(texts)]
    batch = matching.Texts(texts)
    at = np.array([a for *_, a in rows]) + batch.starts
    low, high, sentence = batch.scopes(at, at + 2, 48)
    for r in spark.createDataFrame(rows, "id int, t string, a int").select("*", matching.scope(F.col("t"), F.col("a"), F.col("a") + 2, 48).alias("s")).collect():
        assert tuple(r.s) == (low[r.id] - batch.starts[r.id], high[r.id] - batch.starts[r.id], "sentence" if sentence[r.id] else "window")


@contextmanager
def within(spark, seconds):
    """Jobs that take longer are cancelled, which fails the test."""
    clock = threading.Timer(seconds, spark.sparkContext.cancelAllJobs)
    clock.start()
    yield
    clock.cancel()


def test_a_scope_is_found_in_one_pass_over_a_long_line(spark):
    """Two hundred thousand characters without a mark, then a mark, then the keyword."""
    text = "x" * 200_000 + ";a.b" + "加密" + "y" * 1_000 + "\nz"
    df = spark.createDataFrame([(text, text.index("加密"))], "t string, a int")
    with within(spark, 30):
        assert tuple(df.select(matching.scope(F.col("t"), F.col("a"), F.col("a") + 2, 48).alias("s")).first().s) == (200_001, 201_006, "sentence")


def test_snippets_of_a_long_line(spark, tmp_path):
    spark.createDataFrame([(1, "x" * 200_000 + ";" + "b" * 130 + "License" + "c" * 10 + "\n" + "y" * 200_000)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    with within(spark, 30):
        found = QUERIES["snippets"](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in found] == [(1, "b" * 36 + "license" + "c" * 10 + " " + "y" * 25, "…" + "b" * 120 + "license" + "c" * 10)]


def test_native_spans_of_very_many_hits(spark):
    """A hundred and fifty thousand hits in a text: starts are not summed up in an array that is copied at each."""
    text = "😀under, " * 150_000
    spans = spark.createDataFrame([(text,)], "t string").select(F.explode(matching.keyword_spans(F.col("t"), ["version", "under"])).alias("s"))
    with within(spark, 30):
        n, first, last, total = spans.select("s.start").agg(F.count("*"), F.min("start"), F.max("start"), F.sum("start")).first()
    assert (n, first, last, total) == (150_000, 1, 8 * 149_999 + 1, sum(range(1, len(text), 8)))


def plain_hits(text):
    """The taxonomy's hits in one text, hit by hit and word by word: (keyword, start, contexts asked for and met, (context, start, end) around)."""
    spans = lambda words, t: [m.span() for m in re.finditer("|".join(map(re.escape, sorted(words, key=len, reverse=True))), t)]
    found = []
    for a, b in spans(TAXONOMY.terms, text):
        policy, word = TAXONOMY.terms[text[a:b]]["match_policy"], text[a:b]
        marks = [i for i, c in enumerate(text) if c in matching.BOUNDARIES]
        left, right = [i for i in marks if i < a], [i for i in marks if i >= b]
        low, high = (left[-1] + 1 if left else 0, right[0] if right else len(text)) if left or right else (max(0, a - 48), min(len(text), b + 48))
        around = sorted(((low + x, -low - y, c["id"]) for c, words in TAXONOMY.contexts for x, y in spans(words, text[low:high]) if low + x >= b or low + y <= a))
        met = [c for c in policy.get("required_any", []) if c in {n for *_, n in around}] if policy["mode"] == "cooccurrence" else []
        if word not in [f[0] for f in found] and (met or policy["mode"] != "cooccurrence"):
            found.append((word, a, met, [(n, x, -y) for x, y, n in around]))
    return found


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["零知识证明", "数据", "用户数据", "数据安全", "安全", "泄露", "加密", "。", "a", "甲" * 30]), max_size=14).map("".join), max_size=4))
def test_hits_equal_those_found_one_by_one(texts):
    batch = matching.Texts(texts)
    for text, hits in zip(texts, matching.Evidence(TAXONOMY).keyword_hits(batch, "f")):
        assert [(h["keyword"], h["context_ids"], [(c["context_id"], c["start"], c["end"]) for c in h["context_hits"]]) for h in hits] == [(k, met, around) for k, _, met, around in plain_hits(text)]


def test_a_long_sentence_is_not_its_hits_times_its_words():
    """Two thousand hits of a gated term and as many context words in one sentence, of which one hit is kept."""
    compiled, texts = matching.Evidence(TAXONOMY), matching.Texts(["零知识证明 泄露 " * 2_000 + "。"])
    tracemalloc.start()
    hits = compiled.keyword_hits(texts, "claim")[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(hits) == 1 and [c["start"] for c in hits[0]["context_hits"]] == list(range(6, 18_000, 9)) and peak < 20e6


def test_rows_of_a_batch_are_taken_by_their_characters(spark):
    texts = pd.Series(["a" * n for n in (0, 5, matching.AT_ONCE + 1, 1, matching.AT_ONCE - 1, 1, 0)])
    assert [(r.start, r.stop) for r in matching.runs([texts])] == [(0, 2), (2, 3), (3, 5), (5, 7)]
    assert [(r.start, r.stop) for r in matching.runs([texts, texts[::-1].reset_index(drop=True)])] == [(0, 2), (2, 3), (3, 4), (4, 5), (5, 7)] and not list(matching.runs([texts[:0]]))
    rows = [(i, "加密" * (i % 2) + "x" * 900) for i in range(1_000)]
    found = spark.createDataFrame(rows, "id int, t string").coalesce(1).select("id", matching.evidence({"t": F.col("t")}, TAXONOMY).alias("e"))
    assert [(r.id, r.n) for r in found.select("id", F.size("e.keyword_hits").alias("n")).collect()] == [(i, i % 2) for i in range(1_000)]


def test_texts_of_a_batch_stay_in_arrow_until_their_run():
    """Forty megabytes of text as Python has it, of which a run of 262,144 characters is taken at a time."""
    texts = pa.array(["a😀" + "a" * 9_996 + "加密"] * 1_000)
    kind = pa.struct([("keyword_hits", pa.list_(pa.struct([("keyword", pa.string()), ("field", pa.string())]))), ("diagnostic_hits", pa.list_(pa.struct([("keyword", pa.string())]))), ("normalized", pa.list_(pa.string()))])
    codes = pa.array(["Ｇ０６Ｆ 21/6"] * 1_000)
    tracemalloc.start()
    sizes = [(len(x), {(h[0]["keyword"], h[0]["field"]) for h in x.field("keyword_hits").to_pylist()}, set(map(tuple, x.field("normalized").to_pylist()))) for x in matching.found([texts, codes], ["claim"], TAXONOMY, kind)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(n for n, *_ in sizes) == 1_000 and len(sizes) > 30 and peak < 10e6
    assert all(x == {("加密", "claim")} and codes == {("g06f 21/6",)} for _, x, codes in sizes)


def test_keywords_and_codes_share_a_python_worker(spark):
    df = spark.createDataFrame([(0, "", "加密", "", "Ｇ０６Ｆ21/60", None)], FIELDS)
    routed = routing.route(df, TAXONOMY)
    assert routed._jdf.queryExecution().executedPlan().toString().count("EvalPython") == 1
    assert routed.select("normalized_ipc", "route_level").first() == (["G06F 21/60"], "S") and routed.columns == [*df.columns, "keyword_hits", "diagnostic_hits", "keyword_level", "ipc_hits", "normalized_ipc", "ipc_level", "route_level"]


def workers(df):
    """Python steps of the plan, of which each has a worker in every task."""
    return df._jdf.queryExecution().executedPlan().toString().count("EvalPython")


def test_exploded_hits_are_found_once(spark):
    rows = [(0, "", "数据的加密", "加密", "", ""), (1, "", "甲", "", "", ""), (2, "", "隐私安全", "", "", "")]
    hits = matching.exploded_hits(routing.route_keywords(spark.createDataFrame(rows, FIELDS), TAXONOMY), ["id"])
    assert workers(hits) == 1
    assert sorted((r.id, r.hit_number, r.keyword, r.field) for r in hits.collect()) == [(0, 0, "加密", "abstract"), (0, 1, "加密", "claim"), (2, 0, "隐私安全", "abstract")]


def test_context_hits_are_found_once(spark, tmp_path):
    rows = [(1, "Under a license version 2, under."), (2, "license"), (3, "nothing"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["context_hits"](spark, str(tmp_path))
    assert workers(found) == 1
    assert sorted(map(tuple, found.collect())) == [(1, "window", "A", 1, 16, 1), (1, "window", "B", 2, 0, 3)]


def test_step1_rows_and_statistics(spark):
    names = ["application_number", "publication_number", "grant_number", "application_year", "stock_code", "company_name", "industry", "market"]
    rows = [(str(i), "2020", i + 2, "t", a, "", "", "") for i, a in enumerate(["数据安全。", "隐私安全", "加密数据", "方法", ""])]
    df = spark.createDataFrame(rows, "application_number string, dataset_id string, source_row_number int, title string, abstract string, claim string, ipc string, main_ipc string")
    for n in names[1:]:
        df = df.withColumn(n, F.lit(""))
    routed = routing.route_keywords(df, TAXONOMY)
    flat = {r.patent_id: r for r in routing.step1_rows(routed, TAXONOMY).collect()}
    assert [flat[str(i)].keyword_level for i in range(5)] == list("SWREE")
    hits = json.loads(flat["2"].keyword_hits)
    assert flat["2"].context_hit_count == 1 and hits[0]["context_hits"][0]["keyword"] == "数据" and hits[0]["context_hits"][0]["distance"] == 0
    assert flat["0"].context_scope_modes == "sentence" and flat["3"].keyword_hits == "[]" and flat["0"].taxonomy_version == TAXONOMY.version
    s = routing.route_statistics(routed).first()
    assert (s.records, s.level_s, s.level_w, s.level_r, s.level_e, s.keyword_hits, s.missing_abstract, s.missing_claim) == (5, 1, 1, 1, 2, 3, 1, 5)
    assert s.scope_sentence == 1 and s.scope_window == 2
