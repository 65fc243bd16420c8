import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierloom.operators import groups, metrics, sampling
from tierloom.operators.sampling import SamplingConfig, allocate

CONFIG = SamplingConfig(target_size=40, core_size=30, seed="test-gold-seed", rare_subtype_max=8)


def rows(spark):
    out = []
    for i in range(120):
        cat = [1, 2, 3, 3, 3][i % 5]
        out.append((f"task-{i}", "2021", f"P{i}", i + 2, "SWR"[i % 3], cat, [0.75, 0.85, 0.90, 0.95, 0.99][i % 5], "rare" if i < 8 else "usual", 2 if i % 17 == 0 else 1, cat == 2, "succeeded", f"专利{i // 2}", f"摘要{i // 2}", "主权项", "", ""))
    out += [(f"e-{i}", "2021", f"E{i}", 500 + i, "E", 3, 0.9, "usual", 1, False, "succeeded", "", "", "", "", "") for i in range(20)]
    return spark.createDataFrame(out, "task_id string, dataset_id string, patent_id string, source_row_number int, keyword_level string, cat int, confidence double, subtype string, attempts int, review_flag boolean, status string, title string, abstract string, claim string, ipc string, main_ipc string").withColumn("year", F.col("dataset_id"))


def test_allocation_vectors():
    for minimum in (0, 1):
        assert allocate({"a": 3.0, "b": 2.0, "c": 1.0}, {"a": 3, "b": 2, "c": 1}, 4, minimum) == {"a": 2, "b": 1, "c": 1}
    huge = dict.fromkeys(sampling.RISK, 10**6)
    assert allocate(sampling.RISK, huge, 500) == {"cat2_or_review": 180, "high_conflict": 120, "rare_subtype": 60, "retry_success": 60, "swr_to_cat3": 80}
    tight = dict.fromkeys(sampling.RISK, 100) | {"retry_success": 5}
    assert allocate(sampling.RISK, tight, 100) == {"cat2_or_review": 38, "high_conflict": 26, "rare_subtype": 13, "retry_success": 5, "swr_to_cat3": 18}
    assert allocate({"a": 1.0}, {"a": 0}, 0) == {"a": 0}
    with pytest.raises(ValueError):
        allocate({"a": 1.0}, {"a": 3}, 4)
    with pytest.raises(ValueError):
        allocate({"a": 0.0}, {"a": 3}, 1)


def test_window_form_equals_the_loop(spark):
    sizes = {"g1": {"a": 7, "b": 3, "c": 3, "d": 1}, "g2": {"x": 10, "y": 5}}
    df = spark.createDataFrame([(g, k, n) for g, own in sizes.items() for k, n in own.items()], "g string, k string, n long")
    for quota in (0, 1, 5, 9):
        got = {(r.g, r.k): r.draws for r in sampling.proportional(df, F.lit(float(quota)), ["g"], "k", "n").collect()}
        for g, own in sizes.items():
            assert {k: got[g, k] for k in own} == allocate({k: float(v) for k, v in own.items()}, own, quota)


def test_sample_has_its_sizes_weights_and_stages(spark):
    fit = sampling.enrich(sampling.eligible(rows(spark)), CONFIG)
    allocation = sampling.allocations(fit, CONFIG)
    drawn = sampling.draw(fit, allocation, CONFIG)
    got = drawn.collect()
    assert Counter(r.sample_stage for r in got) == {"representative_core": 30, "risk_addition": 10}
    assert all(r.keyword_level != "E" and abs(r.evaluation_weight * r.inclusion_probability - 1) < 1e-12 and r.inclusion_probability == r.stratum_sample_size / r.stratum_population for r in got)
    assert len({r.sample_id for r in got}) == 40
    assert {r.sample_id for r in got if r.task_id == "task-0"} <= {"GOLD-17994b6e6889e35d"}
    assert "GOLD-" + hashlib.sha256(b"test-gold-seed|sample-id|task-0").hexdigest()[:16] == "GOLD-17994b6e6889e35d"
    again = sampling.draw(fit.repartition(3), allocation, CONFIG).collect()
    assert {(r.task_id, r.sample_stage) for r in again} == {(r.task_id, r.sample_stage) for r in got}
    by = Counter(r.sampling_stratum for r in fit.collect())
    for r in allocation.collect():
        own = sorted((x for x in fit.collect() if x.sampling_stratum == r.sampling_stratum), key=lambda x: hashlib.sha256(f"test-gold-seed|draw|{r.sampling_stratum}|{x.task_id}".encode()).hexdigest())
        assert r.population == by[r.sampling_stratum]
        assert {x.task_id for x in own[: r.sample]} == {x.task_id for x in got if x.sampling_stratum == r.sampling_stratum}
        break
    assert all(r.exact_text_group_size == 2 for r in got)
    table = sampling.strata_table(allocation).collect()
    assert sum(r.sample_size for r in table) == 40 and all((r.evaluation_weight == "") == (r.sample_size == 0) for r in table)


def test_sheets_are_blind(spark):
    fit = sampling.enrich(sampling.eligible(rows(spark)), CONFIG)
    drawn = sampling.draw(fit, sampling.allocations(fit, CONFIG), CONFIG)
    a, b = sampling.annotator_sheet(drawn, "A", "s"), sampling.annotator_sheet(drawn, "B", "s")
    assert len(a.columns) == 26 and not {"keyword_level", "cat", "confidence", "subtype", "risk_flags", "sample_stage"} & set(a.columns)
    ia, ib = [r.sample_id for r in a.collect()], [r.sample_id for r in b.collect()]
    assert ia != ib and sorted(ia) == sorted(ib)
    assert len(sampling.adjudication_sheet(drawn).columns) == 21 and len(sampling.audit_sheet(drawn).columns) == 52
    sums = sampling.distributions(drawn).where("sample_stage is not null and risk_group is null").collect()
    assert {r.sample_stage: r.n for r in sums} == {"representative_core": 30, "risk_addition": 10}


def test_bad_inputs_are_errors(spark):
    df = rows(spark)
    sampling.check(df)
    for bad in (df.withColumn("status", F.when(F.col("task_id") == "task-3", "pending").otherwise("succeeded")), df.union(df.limit(1)), df.withColumn("keyword_level", F.lit("Z"))):
        with pytest.raises(ValueError):
            sampling.check(bad)
    with pytest.raises(ValueError):
        SamplingConfig(target_size=10, core_size=20)
    with pytest.raises(ValueError):
        sampling.allocations(sampling.enrich(sampling.eligible(df), CONFIG, False), SamplingConfig(target_size=1000, core_size=10))
    share = sampling.enrich(sampling.eligible(df), SamplingConfig(40, 30, rare_subtype_share=0.1), False)
    assert share.where("array_contains(risk_flags, 'rare_subtype')").count() == 8


def test_plans_and_bounds():
    assert metrics.plan_sizes(22_318, 1) == {"n_fpc": 1438, "n_year": 385, "n_core": 1500, "n_risk": 500, "n_gold": 2000}
    assert metrics.plan_sizes(178_544, 8)["n_gold"] == 4107 and metrics.plan_sizes(223_180, 10)["n_gold"] == 5134
    assert metrics.test_sizes(4107, 8) == {"m_positive": 385, "n_test": 1284, "n_dev": 822, "n_train": 2001}
    assert abs(metrics.upper_bound(0, 100) - (1 - 0.05 ** (1 / 100))) < 1e-9
    assert metrics.upper_bound(5, 5) == 1.0 and 0.0075 < metrics.upper_bound(10, 2000) < 0.0095


def test_measures(spark):
    data = [(1, 1, 1, 1.0), (2, 1, 3, 2.0), (3, 3, 3, 1.0), (4, 3, 3, 1.0), (5, 3, None, 1.0)]
    df = spark.createDataFrame(data, "id int, truth int, guess int, w double")
    m = {r["class"]: r for r in metrics.class_metrics(df, "truth", "guess", F.col("w")).collect()}
    assert m[1].precision == 1 and abs(m[1].recall - 1 / 3) < 1e-12 and m[3].precision == 0.5 and abs(m[3].recall - 2 / 3) < 1e-12
    assert metrics.rejection_rate(df, "guess").first()[0] == 0.2
    a = metrics.agreement(df, "truth", "guess").first()
    assert a.n == 4 and a.agreement == 0.75 and abs(a.kappa - 0.5) < 1e-12
    assert metrics.confusion(df, "truth", "guess").count() == 4
    assert abs(df.agg(metrics.effective_n(F.col("w"))).first()[0] - 36 / 8) < 1e-12
    assert metrics.macro_f1(metrics.class_metrics(df, "truth", "guess")).first()[0] > 0
    assert metrics.certified(df, F.col("guess").isNull(), 0.9)[0]
    graded = metrics.silver_grades(spark.createDataFrame([(1, 0.97, True, False, False), (1, 0.9, True, False, False), (2, 0.99, True, False, False), (1, 0.99, False, False, False)], "cat int, q double, evidence_valid boolean, anomalous boolean, review_flag boolean"))
    assert [r.grade for r in graded.collect()] == ["A", "B", "C", "D"]


def test_bootstrap_and_calibration(spark):
    df = spark.range(400).select("id", (F.col("id") % 2).cast("double").alias("label"), ((F.col("id") % 2) * 0.5 + (F.col("id") % 10) / 20.0).alias("score"))
    diff = metrics.paired_bootstrap(df, "id", F.col("label"), F.lit(0.0), 50).collect()
    assert len(diff) == 50 and 0.4 < sum(r.difference for r in diff) / 50 < 0.6
    for method in ("logistic", "isotonic"):
        got = metrics.calibrate(df, "score", "label", method)(df).agg(F.avg("calibrated")).first()[0]
        assert abs(got - 0.5) < 0.05
    parts = metrics.grouped_split(df.withColumn("g", F.col("id") % 40), "g", {"a": 0.5, "b": 0.5})
    assert parts.groupBy("g").agg(F.countDistinct("part").alias("n")).where("n > 1").count() == 0


def test_group_sizes_of_hot_rare_and_missing_keys(spark, monkeypatch):
    monkeypatch.setattr(groups, "HOT", 3)
    keys = ["hot"] * 300 + [None] * 40 + [f"k{i % 9}" for i in range(30)] + ["", "#1", "alone"]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "_n int, k string")
    count = Counter(keys)
    assert {r._n: r.size for r in groups.with_group_size(df, "k", "size").collect()} == {i: count[k] for i, k in enumerate(keys)}
    assert groups.with_group_size(df.limit(0), "k", "size").count() == 0


def test_large_strata_are_not_ranked_whole(spark):
    """The ranked rows are those below the bound; a stratum that chance left short is ranked whole."""
    df = spark.range(20_000).select(F.concat(F.lit("t"), "id").alias("task_id"), F.when(F.col("id") < 19_000, "big").otherwise("small").alias("sampling_stratum"))
    allocation = spark.createDataFrame([("big", 19_000, 40, 10, 50), ("small", 1_000, 0, 1_000, 1_000)], "sampling_stratum string, population long, core long, risk long, sample long")
    got = sampling.draw(df, allocation, CONFIG).collect()
    for stratum, n in (("big", 50), ("small", 1_000)):
        ids = [f"t{i}" for i in (range(19_000) if stratum == "big" else range(19_000, 20_000))]
        want = sorted(ids, key=lambda t: hashlib.sha256(f"{CONFIG.seed}|draw|{stratum}|{t}".encode()).hexdigest())[:n]
        assert [r.task_id for r in sorted((r for r in got if r.sampling_stratum == stratum), key=lambda r: r.sample_rank_in_stratum)] == want
    wrong = allocation.withColumn("population", F.col("population") * 1000)  # as if chance had left nearly nothing
    assert len(sampling.draw(df, wrong, CONFIG).collect()) == 1_050
