"""The three steps as functions over files and folders, and as commands: `python -m tierloom.plans.pipeline`."""

from __future__ import annotations

import argparse
import importlib
import os
import signal
import subprocess
import sys
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import classify, routing, sampling, tasks
from ..sources import records, sinks
from ..sources.taxonomy import Taxonomy, load_taxonomy
from ..streaming.task_log import TaskLog


def session(name: str = "tierloom", master: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    return (builder.master(master) if master else builder).getOrCreate()


def step1(spark: SparkSession, path: str | Path, out: str, taxonomy: Taxonomy, limit: int | None = None, overwrite: bool = False) -> dict:
    """Routes one file into `out` by tier and writes a summary beside it. A dataset that is complete is skipped unless asked for."""
    name, begun = records.dataset_id(path), time.monotonic()
    summary_path = Path(out) / f"summary_{name}.json"
    if summary_path.exists() and not overwrite:
        return sinks.read_json(summary_path)
    rows = records.read_records(spark, path, limit=limit)
    width = spark.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < width:  # a file of few blocks: its records go to all cores before the matcher
        rows = rows.repartition(width)
    routed = routing.route_keywords(rows, taxonomy)
    target = f"{out}/keyword_{name}"
    sinks.write_tiers(routing.step1_rows(routed, taxonomy), target, overwrite)
    # counts come from what was written; nothing is routed twice
    done = spark.read.parquet(target)
    level = lambda t: F.sum(F.when(F.col("keyword_level") == t, 1).otherwise(0)).alias(t)
    counts = done.agg(F.count("*").alias("records"), *[level(t) for t in "SWRE"], F.sum("keyword_hit_count").alias("keyword_hits"), F.sum("context_hit_count").alias("context_hits")).first().asDict()
    seconds = time.monotonic() - begun
    summary = {"dataset_id": name, "input": str(path), "taxonomy_version": taxonomy.version, **{k: v or 0 for k, v in counts.items()}, "seconds": round(seconds, 3), "records_per_second": round(counts["records"] / seconds, 3)}
    sinks.write_json(summary, summary_path)
    return summary


def step2_prepare(spark: SparkSession, path: str | Path, step1_dir: str, folder: str, rate: float = tasks.RATE, seed: str = tasks.SEED, rebuild: bool = False) -> dict:
    """Writes the tasks of one dataset. The same inputs give the summary that is there; different ones are an error."""
    name = records.dataset_id(path)
    asked = {"input_path": str(Path(path).resolve()), "input_size_bytes": Path(path).stat().st_size, "e_sample_rate": rate, "e_sample_seed": seed}
    there = sinks.read_json(Path(folder) / "prepared.json")
    if there and not rebuild:
        if differs := {k: (there.get(k), v) for k, v in asked.items() if there.get(k) != v}:
            raise ValueError(f"prepared from other inputs: {differs}")
        return there
    if rebuild:
        for part in ("tasks", "claims", "attempts", "stream", "prepared.json", "progress.json"):
            sinks.clear(Path(folder) / part)
    routed = spark.read.parquet(f"{step1_dir}/keyword_{name}").withColumn("dataset_id", F.lit(name))
    selected = tasks.select_tasks(routed, rate, seed)
    rows = records.read_records(spark, path)
    prepared = tasks.prepare_tasks(selected, rows)
    sinks.write_table(prepared, f"{folder}/tasks", overwrite=True)
    wanted, got = selected.count(), spark.read.parquet(f"{folder}/tasks").count()
    if wanted != got:
        raise ValueError(f"{got} of {wanted} selected rows are in the input")
    sizes = {r.keyword_level: r.unique_patents for r in tasks.population(routed).collect()}
    summary = {"dataset_id": name, **asked, "unique": sizes, "total_tasks": got}
    sinks.write_json(summary, Path(folder) / "prepared.json")
    return summary


def step2_export(log: TaskLog, path: str) -> None:
    sinks.write_sheet(classify.results(log.state()), path, overwrite=True)


def step3(spark: SparkSession, folders: list[str], out: str, config: sampling.SamplingConfig = sampling.SamplingConfig(), rebuild: bool = False) -> dict[str, DataFrame]:
    """Draws the sample over several task folders and writes all sheets; refuses if any is there."""
    names = ("gold_sample_audit.csv", "gold_sample_blinded.csv", "annotation_round1_A.csv", "annotation_round1_B.csv", "adjudication_template.csv", "sampling_strata.csv", "sampling_report.json", "annotation_schema.json")
    if not rebuild and (found := [n for n in names if (Path(out) / n).exists()]):
        raise FileExistsError(f"already written: {found}")
    frames = [TaskLog(spark, f).state() for f in folders]
    state = frames[0]
    for more in frames[1:]:
        state = state.unionByName(more, allowMissingColumns=True)
    got = F.from_json("result_json", classify.RESPONSE)
    body = F.from_json("payload_json", "title string, abstract string, claim string, ipc string, main_ipc string")
    rows = state.withColumns({"_r": got, "_p": body})
    rows = rows.select(*[c for c in state.columns if c not in ("result_json", "raw_response")], F.col("dataset_id").alias("year"), "_p.*", *[F.col(f"_r.{k}").alias(k) for k in classify.KEYS if k not in ("evidence_chain", "evidence")], F.to_json("_r.evidence").alias("evidence"), *[F.col(f"_r.evidence_chain.{c}").alias(c) for c in classify.CHAIN])
    sampling.check(rows)
    fit = sampling.enrich(sampling.eligible(rows), config)
    allocation = sampling.allocations(fit, config)
    drawn = sampling.draw(fit, allocation, config)
    sheets = {
        "gold_sample_audit.csv": sampling.audit_sheet(drawn), "gold_sample_blinded.csv": sampling.blinded_sheet(drawn).orderBy("sample_id"),
        "annotation_round1_A.csv": sampling.annotator_sheet(drawn, "A", config.seed), "annotation_round1_B.csv": sampling.annotator_sheet(drawn, "B", config.seed),
        "adjudication_template.csv": sampling.adjudication_sheet(drawn), "sampling_strata.csv": sampling.strata_table(allocation),
    }
    for name, sheet in sheets.items():
        sinks.write_sheet(sheet, Path(out) / name, overwrite=rebuild)
    report = {"seed": config.seed, "target_size": config.target_size, "core": config.core_size, "eligible": fit.count(), "excluded_E": rows.where("keyword_level = 'E'").count(), "distributions": [r.asDict() for r in sampling.distributions(drawn).collect()]}
    sinks.write_json(report, Path(out) / "sampling_report.json")
    sinks.write_json({"round1": {"human_cat": [1, 2, 3], "annotation_status": ["completed", "skipped"], "human_review_state": ["resolved", "needs_adjudication", "unresolved"], "duplicate_or_unreadable": ["false", "duplicate", "unreadable"]}, "adjudication": {"final_human_cat": [1, 3], "human_review_state": ["resolved", "unresolved"], "adjudication_status": ["completed", "not_required"]}}, Path(out) / "annotation_schema.json")
    return sheets


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tierloom")
    sub = parser.add_subparsers(dest="command", required=True)
    one = sub.add_parser("step1", help="route files by tier")
    one.add_argument("--input", nargs="*", default=[])
    one.add_argument("--input-dir")
    one.add_argument("--pattern", default="*.csv")
    one.add_argument("--lexicon", required=True)
    one.add_argument("--codes", required=True)
    one.add_argument("--limit", type=int)
    one.add_argument("--overwrite", action="store_true")
    two = sub.add_parser("step2", help="prepare, run or show classification tasks")
    two.add_argument("action", choices=["prepare", "run", "stream", "start", "stop", "status", "export"])
    two.add_argument("--input", nargs="*", default=[])
    two.add_argument("--step1")
    two.add_argument("--rate", type=float, default=tasks.RATE)
    two.add_argument("--seed", default=tasks.SEED)
    two.add_argument("--rebuild", action="store_true")
    two.add_argument("--classifier", help="module:function that takes a payload and returns raw_text")
    two.add_argument("--model", default="")
    two.add_argument("--concurrency", type=int, default=1)
    two.add_argument("--max-attempts", type=int, default=3)
    two.add_argument("--dataset", nargs="*", default=[])
    two.add_argument("--retry-delay", type=float, default=2.0)
    three = sub.add_parser("step3", help="draw the sample and write the sheets")
    three.add_argument("--tasks", nargs="+", required=True)
    three.add_argument("--target", type=int, default=2000)
    three.add_argument("--core", type=int, default=1500)
    three.add_argument("--seed", default="step3-gold-v1")
    three.add_argument("--rebuild", action="store_true")
    for p in (one, two, three):
        p.add_argument("--out", required=True)
        p.add_argument("--master")
    a = parser.parse_args(argv)
    if a.command == "step2" and a.action == "start":  # a process of its own that runs on
        given = [x if x != "start" else "run" for x in (sys.argv[1:] if argv is None else argv)]
        print(subprocess.Popen([sys.executable, "-m", __spec__.name, *given], start_new_session=True).pid)
        return
    if a.command == "step2" and a.action == "stop":  # the runner's process id is in its lock file
        for name in a.dataset:
            os.kill(int((Path(a.out) / name / "runner.lock").read_text()), signal.SIGTERM)
        return
    stopped = threading.Event()
    signal.signal(signal.SIGTERM, lambda *_: stopped.set())
    spark = session(master=a.master)
    if a.command == "step1":
        taxonomy = load_taxonomy(a.lexicon, a.codes)
        with ThreadPoolExecutor(4) as pool:  # files side by side: the tail of one leaves cores to the next
            for summary in pool.map(lambda path: step1(spark, path, a.out, taxonomy, a.limit, a.overwrite), records.discover_files(a.input, a.input_dir, a.pattern)):
                print(summary)
    elif a.command == "step2":
        if a.action == "prepare":
            for path in records.discover_files(a.input):
                print(step2_prepare(spark, path, a.step1, f"{a.out}/{records.dataset_id(path)}", a.rate, a.seed, a.rebuild))
        for name in a.dataset if a.action != "prepare" else ():
            log = TaskLog(spark, f"{a.out}/{name}", a.max_attempts)
            if a.action == "status":
                tasks.progress(log.state(), a.concurrency).show(truncate=False)
            elif a.action == "export":
                step2_export(log, f"{a.out}/results_{name}.csv")
            else:
                module, _, function = a.classifier.partition(":")
                classifier = getattr(importlib.import_module(module), function)
                if a.action == "run" and a.concurrency == 1:
                    log.run_serial(classifier, a.model, a.retry_delay, stopped.is_set)
                elif a.action == "run":
                    log.run(classifier, a.model, a.concurrency, retry_delay=a.retry_delay, stop=stopped.is_set)
                else:
                    log.stream(classifier, a.model, a.concurrency)
    else:
        step3(spark, a.tasks, a.out, sampling.SamplingConfig(a.target, a.core, a.seed), a.rebuild)


if __name__ == "__main__":
    main()
