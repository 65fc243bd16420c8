import json

import pytest
from pyspark.sql import functions as F

from tierloom.operators import classify, tasks
from tierloom.operators.tasks import ATTEMPTS
from tierloom.plans import pipeline
from tierloom.streaming.task_log import TaskLog

from .test_routing import TAXONOMY, within
from .test_sources import HEADER, write


def answer(payload, **change):
    chain = dict.fromkeys(classify.CHAIN, "x") | {"missing_or_ambiguous_link": ""}
    body = {"cat": 1, "confidence": 0.9, "subtype": "data_integrity", "core_invention": "c", "evidence_chain": chain, "evidence": ["e"], "reason": "r", "review_flag": False, "review_reason": ""}
    return {"raw_text": json.dumps(body | change), "response_id": "id", "actual_model": "m1"}


def test_golden_identities(spark):
    rows = [("2021", "CN-S"), ("2020", "CN-SAME"), ("2021", "CN-SAME"), ("2020", "CN-E-0")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, d string, p string")
    got = df.select("i", tasks.task_id(F.col("d"), F.col("p")).alias("t"), tasks.uniform(tasks.SEED, F.col("d"), F.col("p")).alias("u")).orderBy("i").collect()
    assert [r.t for r in got[:3]] == ["patent-2021-0f79c254846a5ec3f3753c58", "patent-2020-ea5225fc136716b2a05771a8", "patent-2021-b36f2010b59f0e9a263dff23"]
    assert abs(got[3].u - 0.21045434930650217) < 1e-15
    sample = spark.range(500).select(F.lit("2020").alias("d"), F.concat(F.lit("CN-E-"), "id").alias("p"), "id").where(tasks.uniform(tasks.SEED, F.col("d"), F.col("p")) < 0.02)
    assert sorted(r.id for r in sample.collect()) == [16, 71, 98, 128, 157, 204, 229, 246, 271, 293, 294, 484]


def test_many_quick_calls_are_handed_on_together_and_parsed_once(spark):
    """Eight thousand calls in one task; three in eight thousand fail, one breaks a rule."""
    n = 8_000

    def classifier(payload):
        if payload["k"] in (5, 300, 7_999):
            raise RuntimeError("busy")
        return answer(payload, confidence=1.5 if payload["k"] == 256 else 0.9)

    rows = spark.range(n).coalesce(1).select(F.col("id").cast("string").alias("task_id"), F.to_json(F.struct(F.col("id").alias("k"))).alias("payload_json"), F.lit(1).alias("attempts"))
    for workers in (1, 4):
        done = classify.run_classifier(rows, classifier, "m", workers)
        with within(spark, 15):
            ended = done.collect()
        assert [r.task_id for r in ended] == [str(k) for k in range(n)] and {r.attempt for r in ended} == {2}
        assert {r.task_id: r.error for r in ended if r.status != "succeeded"} == dict.fromkeys(("5", "300", "7999"), "RuntimeError: busy") | {"256": "ValidationError: confidence"}
    raw = spark.createDataFrame([(answer({})["raw_text"],)], "raw string")
    plan = raw.select(classify.violations(classify.parsed(F.col("raw")), F.col("raw")).alias("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_selection_takes_the_strongest_tier(spark):
    rows = [("d", "p1", 2, "E"), ("d", "p1", 5, "W"), ("d", "p1", 4, "W"), ("d", "p2", 3, "R"), ("d", "p3", 6, "E"), ("d", "p3", 7, "E"), ("e", "p1", 2, "S")]
    df = spark.createDataFrame(rows, "dataset_id string, patent_id string, source_row_number int, keyword_level string")
    got = {(r.dataset_id, r.patent_id): r for r in tasks.select_tasks(df, 1.0).collect()}
    assert {k: (r.source_row_number, r.selection_group) for k, r in got.items()} == {("d", "p1"): (4, "W"), ("d", "p2"): (3, "R"), ("d", "p3"): (6, "E_sample"), ("e", "p1"): (2, "S")}
    with pytest.raises(ValueError):
        tasks.select_tasks(df, 0)
    few = tasks.select_tasks(df, 1e-9).collect()
    assert len(few) == 3 and all(r.sample_weight == 1 for r in few)


def test_state_and_progress(spark):
    made = spark.createDataFrame([("d", f"t{i}", "SWRE"[i % 4], i) for i in range(5)], "dataset_id string, task_id string, keyword_level string, source_row_number int")
    log = [("t0", 1, "failed", 1.0), ("t0", 2, "succeeded", 2.0), ("t0", 2, "succeeded", 2.0), ("t1", 1, "failed", 3.0), ("t2", 1, "failed", 1.0), ("t2", 2, "failed", 1.0), ("t2", 3, "failed", 1.0)]
    attempts = spark.createDataFrame(log, "task_id string, attempt int, status string, elapsed_seconds double").withColumns({c: F.lit(None).cast("string") for c in ("actual_model", "error", "result_json", "requested_model", "response_id", "raw_response", "usage_json", "prompt_version", "finished_at")})
    state = tasks.latest_state(made, attempts)
    assert {r.task_id: (r.status, r.attempts, r.elapsed_seconds) for r in state.collect()} == {"t0": ("succeeded", 2, 3.0), "t1": ("pending", 1, 3.0), "t2": ("failed", 3, 3.0), "t3": ("pending", 0, 0.0), "t4": ("pending", 0, 0.0)}
    assert [r.task_id for r in tasks.claim(state, 2).collect()] == ["t4", "t1"]
    assert [r.task_id for r in tasks.claim(state, 9, waiting=state.where("task_id = 't4'")).collect()] == ["t1", "t3"]
    p = tasks.progress(state, 2).first()
    assert (p.total, p.completed, p.pending, p.progress_percent, p.average_request_seconds, p.average_completed_task_seconds, p.eta_seconds) == (5, 2, 3, 40.0, 1.5, 3.0, 4.5)
    nothing = tasks.progress(tasks.latest_state(made, attempts.limit(0))).first()
    assert nothing.eta_seconds is None and nothing.completed == 0


@pytest.mark.parametrize(
    "change,broken",
    [
        ({}, []), ({"cat": 4}, ["cat", "subtype_for_cat"]), ({"confidence": 1.1}, ["confidence"]), ({"subtype": "nope"}, ["subtype", "subtype_for_cat"]), ({"core_invention": ""}, ["core_invention"]),
        ({"evidence": []}, ["evidence"]), ({"evidence": list("abcd")}, ["evidence"]), ({"cat": 3, "subtype": "other"}, []), ({"cat": 3}, ["subtype_for_cat"]),
        ({"cat": 2, "subtype": "potential_data_security"}, ["cat2_needs_review", "cat2_no_link"]), ({"review_flag": True}, ["review_without_reason"]), ({"reason": "x" * 801}, ["reason"]), ({"more": 1}, ["extra_keys"]),
    ],
)
def test_response_rules(spark, change, broken):
    raw = answer({}, **change)["raw_text"]
    df = spark.createDataFrame([(raw,), (f"```json\n{raw}\n```",)], "raw string")
    for r in df.select(classify.violations(classify.parsed(F.col("raw")), F.col("raw")).alias("v")).collect():
        assert r.v == broken


def test_prompt_hides_routing_and_cuts_long_fields(spark):
    body = json.dumps({"title": "t", "abstract": "a" * 7000, "claim": "c" * 11000, "ipc": "i", "main_ipc": "m", "keyword_level": "S"})
    p = spark.createDataFrame([(body,)], "b string").select(classify.prompt(F.col("b"), "do", "{}").alias("p")).first().p
    assert "keyword_level" not in p and "a" * 6000 in p and "a" * 6001 not in p and "c" * 10001 not in p


@pytest.fixture
def raw(tmp_path):
    rows = ["数据安全", "隐私安全", "加密", "数据安全", *["无关"] * 30]
    ids = ["CN-S", "CN-W", "CN-R", "CN-S", *[f"CN-E-{i}" for i in range(30)]]
    lines = [f",,Firm{i},T{i},{p},2021,,,{a},," for i, (a, p) in enumerate(zip(rows, ids))]
    return write(tmp_path / "raw_2021.csv", HEADER, *lines)


def test_three_steps_end_to_end(spark, raw, tmp_path):
    out = str(tmp_path / "s1")
    first = pipeline.step1(spark, raw, out, TAXONOMY)
    assert (first["records"], first["S"], first["W"], first["R"], first["E"]) == (34, 2, 1, 1, 30)
    assert pipeline.step1(spark, raw, out, TAXONOMY) == first
    folder = str(tmp_path / "tasks/2021")
    made = pipeline.step2_prepare(spark, raw, out, folder, rate=0.5)
    assert made["unique"] == {"S": 1, "W": 1, "R": 1, "E": 30} and 3 < made["total_tasks"] < 33
    assert pipeline.step2_prepare(spark, raw, out, folder, rate=0.5) == made
    with pytest.raises(ValueError):
        pipeline.step2_prepare(spark, raw, out, folder, rate=0.25)
    log = TaskLog(spark, folder)
    payload = json.loads(log.tasks.where("patent_id = 'CN-S'").first().payload_json)
    assert payload == {"title": "T0", "abstract": "数据安全", "claim": "", "ipc": "", "main_ipc": ""}

    def picky(p):
        if "加密" in p["abstract"]:
            raise RuntimeError("busy")
        return answer(p) if "隐私" not in p["abstract"] else {"raw_text": "no json"}

    log.run(picky, "asked", workers=2)
    state = {r.patent_id: r for r in log.state().collect()}
    assert state["CN-S"].status == "succeeded" and state["CN-S"].attempts == 1
    assert state["CN-R"].status == "failed" and state["CN-R"].attempts == 3 and state["CN-R"].error == "RuntimeError: busy"
    assert state["CN-W"].status == "failed" and state["CN-W"].error.startswith("ValidationError: object")
    pipeline.step2_export(log, str(tmp_path / "r.csv"))
    lines = (tmp_path / "r.csv").read_text(encoding="utf-8-sig").splitlines()
    assert len(lines[0].split(",")) == 31 and len(lines) == made["total_tasks"] + 1
    assert json.loads((tmp_path / "tasks/2021/progress.json").read_text())["2021"]["completed"] == made["total_tasks"]


def test_stream_resumes_and_adds_nothing_twice(spark, raw, tmp_path):
    out, folder = str(tmp_path / "s1"), str(tmp_path / "t")
    pipeline.step1(spark, raw, out, TAXONOMY)
    pipeline.step2_prepare(spark, raw, out, folder, rate=0.5)
    log = TaskLog(spark, folder)
    log.stream(answer)
    n = log.attempts.count()
    assert n == log.tasks.count() and {r.status for r in log.state().collect()} == {"succeeded"}
    log.stream(answer)
    assert log.attempts.count() == n
    more = log.tasks.limit(1).withColumn("task_id", F.lit("new")).collect()
    spark.createDataFrame(more, log.tasks.schema).write.mode("append").parquet(f"{folder}/tasks")
    log.stream(answer)
    assert log.attempts.count() == n + 1


def test_one_runner_at_a_time(spark, tmp_path):
    log = TaskLog(spark, str(tmp_path))
    with log.owned(), pytest.raises(RuntimeError), TaskLog(spark, str(tmp_path)).owned():
        pass
    with log.owned():
        pass


def test_failed_tasks_wait_while_others_go_on(spark, tmp_path):
    made = spark.createDataFrame([("d", i, f"p{i}", "S", "S", 1.0, 1.0, json.dumps({"title": str(i), "abstract": "", "claim": "", "ipc": "", "main_ipc": ""}), f"t{i}") for i in range(2)], "dataset_id string, source_row_number int, patent_id string, keyword_level string, selection_group string, selection_probability double, sample_weight double, payload_json string, task_id string")
    made.write.parquet(f"{tmp_path}/tasks")
    log = TaskLog(spark, str(tmp_path), max_attempts=2)

    def first_fails(p):
        if p["title"] == "0":
            raise TimeoutError("later")
        return answer(p)

    log.run(first_fails, batch=1, retry_delay=1.5)
    done = [(r.task_id, r.attempt) for r in log.attempts.orderBy("finished_at").collect()]
    assert done == [("t0", 1), ("t1", 1), ("t0", 2)]
    log.run(first_fails, stop=lambda: True)
    assert log.attempts.count() == 3


def made_tasks(spark, folder, n):
    body = lambda i: json.dumps({"title": str(i), "abstract": "", "claim": "", "ipc": "", "main_ipc": ""})
    rows = [("d", i, f"p{i}", "S", "S", 1.0, 1.0, body(i), f"t{i}") for i in range(n)]
    spark.createDataFrame(rows, "dataset_id string, source_row_number int, patent_id string, keyword_level string, selection_group string, selection_probability double, sample_weight double, payload_json string, task_id string").write.parquet(f"{folder}/tasks")


def test_claims_count_when_a_run_is_cut_off(spark, tmp_path):
    """A claim without an outcome is an attempt; with none left, the task is stuck and is not called again."""
    made_tasks(spark, tmp_path, 3)
    log = TaskLog(spark, str(tmp_path), max_attempts=2)
    spark.createDataFrame([("t0", 1, "x"), ("t1", 1, "x"), ("t1", 2, "x")], "task_id string, attempt int, claimed_at string").write.parquet(f"{tmp_path}/claims")
    assert [r.task_id for r in tasks.stuck(log.state(), 2).collect()] == ["t1"]
    log.run(answer, workers=2)
    assert sorted((r.task_id, r.attempt) for r in log.attempts.collect()) == [("t0", 2), ("t2", 1)]
    assert {r.task_id: (r.status, r.attempts) for r in log.state().collect()} == {"t0": ("succeeded", 2), "t1": ("pending", 2), "t2": ("succeeded", 1)}


def test_a_stop_lets_calls_end_and_releases_the_rest(spark, tmp_path):
    import time

    made_tasks(spark, tmp_path, 40)
    log = TaskLog(spark, str(tmp_path))

    def slow(p):
        (tmp_path / "called").touch()
        time.sleep(0.5)
        return answer(p)

    log.run(slow, stop=lambda: (tmp_path / "called").exists())
    state = log.state().collect()
    done = [r for r in state if r.status == "succeeded"]
    assert 0 < len(done) < 40 and all(r.attempts == 0 for r in state if r.status == "pending")
    log.run(answer)
    assert {(r.status, r.attempts) for r in log.state().collect()} == {("succeeded", 1)}


def test_serial_runs_try_the_same_task_first(spark, tmp_path):
    made_tasks(spark, tmp_path, 2)
    log = TaskLog(spark, str(tmp_path), max_attempts=2)

    def first_fails(p):
        if p["title"] == "0":
            raise TimeoutError("later")
        return answer(p)

    log.run_serial(first_fails, retry_delay=0.2)
    assert [(r.task_id, r.attempt) for r in log.attempts.orderBy("finished_at").collect()] == [("t0", 1), ("t0", 2), ("t1", 1)]


def classifier_of_the_command(payload):
    return answer(payload)


def test_commands_from_end_to_end(spark, raw, tmp_path):
    (tmp_path / "terms.json").write_text(json.dumps(TAXONOMY.docs), encoding="utf-8")
    (tmp_path / "codes.json").write_text(json.dumps(TAXONOMY.ipc), encoding="utf-8")
    out, folder = str(tmp_path / "s1"), str(tmp_path / "t")
    pipeline.main(["step1", "--input", str(raw), "--lexicon", str(tmp_path / "terms.json"), "--codes", str(tmp_path / "codes.json"), "--out", out])
    pipeline.main(["step2", "prepare", "--input", str(raw), "--step1", out, "--out", folder, "--rate", "0.5"])
    pipeline.main(["step2", "run", "--dataset", "2021", "--out", folder, "--classifier", "tests.test_tasks:classifier_of_the_command", "--concurrency", "2"])
    pipeline.main(["step2", "status", "--dataset", "2021", "--out", folder])
    pipeline.main(["step2", "export", "--dataset", "2021", "--out", folder])
    n = TaskLog(spark, f"{folder}/2021").tasks.count()
    assert len((tmp_path / "t/results_2021.csv").read_text(encoding="utf-8-sig").splitlines()) == n + 1


def test_state_files_of_other_tools(spark, tmp_path):
    import sqlite3

    from tierloom.sources import state_files

    for year in (2020, 2021):
        db = sqlite3.connect(tmp_path / f"classification_state_{year}.sqlite3")
        db.execute("create table tasks (task_id text, dataset_id text, patent_id text, source_row_number integer, keyword_level text, status text, attempts integer, elapsed_seconds real)")
        db.executemany("insert into tasks values (?, ?, ?, ?, 'S', 'succeeded', 1, 0.5)", [(f"t{year}{i}", str(year), f"P{i}", i) for i in range(3)])
        db.commit()
        db.close()
    files = state_files.discover_state_files(tmp_path)
    assert [p.name[-12:-8] for p in files] == ["2020", "2021"]
    got = state_files.read_state_files(spark, files)
    assert got.count() == 6 and len(got.columns) == 22 and got.first().raw_response is None
    assert {r.tasks for r in state_files.manifest(spark, files).collect()} == {3}
    (tmp_path / "classification_state_x.sqlite3").write_bytes(b"not a database" * 100)
    with pytest.raises(Exception, match="(?i)database"):
        state_files.read_state_files(spark, [tmp_path / "classification_state_x.sqlite3"]).count()
    with pytest.raises(FileNotFoundError):
        state_files.read_state_files(spark, [tmp_path / "none.sqlite3"])


def test_attempt_columns_are_stable():
    assert len(ATTEMPTS.split(", ")) == 13
