"""The classifier's surface: prompts, responses and their rules, and running any callable over tasks."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from itertools import batched

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tasks import ATTEMPTS

# Fixed value: written where an attempt has no version of its own.
PROMPT_VERSION = "data-security-three-class-v2.1.0"
# Subtypes by class.
SUBTYPES = {
    1: "privacy_protection privacy_computing data_access_control data_confidentiality data_integrity data_availability data_governance data_monitoring_response data_provenance_accountability other_data_security".split(),
    2: ["potential_data_security"],
    3: ["other"],
}
#: Length bounds in code points, (least, most).
BOUNDS = {"core_invention": (1, 500), "evidence_chain.protected_object_or_activity": (1, 500), "evidence_chain.security_goal_or_risk": (1, 500), "evidence_chain.technical_mechanism": (1, 800), "evidence_chain.causal_centrality": (1, 500), "evidence_chain.missing_or_ambiguous_link": (0, 500), "reason": (1, 800), "review_reason": (0, 400)}
CHAIN = ("protected_object_or_activity", "security_goal_or_risk", "technical_mechanism", "causal_centrality", "missing_or_ambiguous_link")
RESPONSE = "struct<cat:int,confidence:double,subtype:string,core_invention:string,evidence_chain:struct<" + ",".join(f"{c}:string" for c in CHAIN) + ">,evidence:array<string>,reason:string,review_flag:boolean,review_reason:string>"
KEYS = ("cat", "confidence", "subtype", "core_invention", "evidence_chain", "evidence", "reason", "review_flag", "review_reason")
LIMITS = {"abstract": 6_000, "claim": 10_000}


def truncated(column: Column, limit: int) -> Column:
    return F.substring(column, 1, limit)


def prompt(payload_json: Column, instruction: str, schema: str) -> Column:
    """Instruction, the five evidence fields with long ones cut, and the schema asked for."""
    fields = F.from_json(payload_json, "title string, abstract string, claim string, ipc string, main_ipc string")
    cut = lambda f: truncated(fields[f], LIMITS[f]) if f in LIMITS else fields[f]
    evidence = F.to_json(F.struct(*[F.coalesce(cut(f), F.lit("")).alias(f) for f in ("title", "abstract", "claim", "ipc", "main_ipc")]))
    return F.concat(F.lit(instruction + "\n\n"), evidence, F.lit("\n\n" + schema))


def json_object(raw: Column) -> Column:
    """The object in a model's answer: a code fence taken off, from the first brace to the last; null if there is none."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(raw), r"^```(?:json|JSON)?\s*", ""), r"\s*```$", "")
    return F.nullif(F.regexp_extract(bare, r"(?s)(\{.*\})", 1), F.lit(""))


def parsed(raw: Column) -> Column:
    return F.from_json(json_object(raw), RESPONSE)


def violations(response: Column, raw: Column | None = None) -> Column:
    """Names of the rules that a parsed response breaks; empty means valid. With `raw`, unknown keys count too.

    Both are bound first: else the optimizer parses the answer anew for each field that a rule looks at.
    """
    let = lambda value, body: F.element_at(F.transform(F.array(value), body), 1)
    if raw is None:
        return let(response, _violations)
    return let(F.struct(response.alias("response"), json_object(raw).alias("object")), lambda x: _violations(x.response, x.object))


def _violations(r: Column, body: Column | None = None) -> Column:
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    rules = []
    rule = lambda name, broken: rules.append(F.when(F.coalesce(broken, F.lit(True)), F.lit(name)))
    rule("object", r.isNull())
    rule("cat", ~r["cat"].isin(1, 2, 3))
    rule("confidence", ~r["confidence"].between(0, 1))
    rule("subtype", ~r["subtype"].isin([s for names in SUBTYPES.values() for s in names]))
    for path, (least, most) in BOUNDS.items():
        field = r
        for part in path.split("."):
            field = field[part]
        rule(path, ~F.length(field).between(least, most))
    rule("evidence", ~F.size(r["evidence"]).between(1, 3) | F.exists(r["evidence"], lambda e: e.isNull()))
    rule("review_flag", r["review_flag"].isNull())
    link = r["evidence_chain"]["missing_or_ambiguous_link"]
    fits = F.lit(False)
    for cat, names in SUBTYPES.items():
        fits = fits | ((r["cat"] == cat) & r["subtype"].isin(names))
    rule("subtype_for_cat", ~fits)
    rule("cat2_needs_review", (r["cat"] == 2) & ~r["review_flag"])
    rule("cat1_open_link", (r["cat"] == 1) & ~blank(link))
    rule("cat2_no_link", (r["cat"] == 2) & blank(link))
    rule("review_without_reason", r["review_flag"] & blank(r["review_reason"]))
    if body is not None:
        keys = F.json_object_keys(body)
        chain = F.json_object_keys(F.get_json_object(body, "$.evidence_chain"))
        rule("extra_keys", (F.size(F.array_except(keys, F.lit(list(KEYS)))) > 0) | (F.size(F.array_except(chain, F.lit(list(CHAIN)))) > 0))
    return F.array_compact(F.array(*rules))


def results(state: DataFrame) -> DataFrame:
    """Final states as flat rows of 31 columns; what is missing is empty."""
    got = F.from_json("result_json", RESPONSE)
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    final = state.where(F.col("status").isin("succeeded", "failed")).withColumn("_r", got)
    r = F.col("_r")
    return final.select(
        "task_id", "dataset_id", "patent_id", "source_row_number", "keyword_level", "selection_group", "selection_probability", "sample_weight", "status", "attempts",
        text(F.col("requested_model")).alias("requested_model"), text(F.col("actual_model")).alias("actual_model"), F.coalesce("prompt_version", F.lit(PROMPT_VERSION)).alias("prompt_version"), text(F.col("response_id")).alias("response_id"),
        *[text(r[c]).alias(c) for c in ("cat", "confidence", "subtype", "core_invention")],
        *[text(r["evidence_chain"][c]).alias(c) for c in CHAIN],
        F.coalesce(F.to_json(r["evidence"]), F.lit("[]")).alias("evidence"), text(r["reason"]).alias("reason"), text(r["review_flag"]).alias("review_flag"), text(r["review_reason"]).alias("review_reason"),
        F.round("elapsed_seconds", 3).alias("elapsed_seconds"), F.coalesce("usage_json", F.lit("{}")).alias("usage"), text(F.col("error")).alias("error"), text(F.col("finished_at")).alias("completed_at"),
    ).orderBy("dataset_id", "source_row_number")


#: Written in place of an error where a stop came before the call.
RELEASED = "released before the call"
#: Outcomes that a worker hands on at once: a frame for each would cost more than most else here.
TOGETHER = 256


def run_classifier(claimed: DataFrame, classify: Callable[[dict], dict], model: str = "", workers: int = 1, stop_file: str | None = None) -> DataFrame:
    """One attempt for each claimed task, as rows of the attempts log.

    `classify` takes the payload and returns raw_text, and may return response_id, actual_model and usage. It runs
    in the executors, up to `workers` calls at once in a task; whatever it raises is a failed attempt. Once `stop_file` is
    there, no further call is made: calls under way end, the other tasks are released.
    """

    def attempt(row) -> tuple:
        if stop_file and os.path.exists(stop_file):
            released = dict.fromkeys(("actual_model", "response_id", "raw_response", "usage_json")) | {"error": RELEASED}
            return row.task_id, int(row.attempts) + 1, released, 0.0, datetime.now(UTC).isoformat()
        start = time.monotonic()
        out = dict.fromkeys(("actual_model", "response_id", "raw_response", "usage_json", "error"))
        try:
            answer = classify(json.loads(row.payload_json))
            out |= {"actual_model": answer.get("actual_model", model), "response_id": answer.get("response_id", ""), "raw_response": answer["raw_text"], "usage_json": json.dumps(answer.get("usage", {}), ensure_ascii=False)}
        except Exception as e:  # noqa: BLE001
            out["error"] = f"{type(e).__name__}: {e}"[:2000]
        return row.task_id, int(row.attempts) + 1, out, time.monotonic() - start, datetime.now(UTC).isoformat()

    def run(batches) -> Iterator:
        from concurrent.futures import ThreadPoolExecutor

        import pandas as pd

        def rows(some: list[tuple]) -> pd.DataFrame:
            found = [{"task_id": t, "attempt": n, "status": None, "requested_model": model, "result_json": None, "elapsed_seconds": seconds, "prompt_version": PROMPT_VERSION, "finished_at": at, **out} for t, n, out, seconds, at in some]
            return pd.DataFrame(found, columns=[c.split()[0] for c in ATTEMPTS.split(", ")])

        with ThreadPoolExecutor(max(1, workers)) as pool:
            for batch in batches:
                ended = pool.map(attempt, batch.itertuples()) if workers > 1 else map(attempt, batch.itertuples())
                for some in batched(ended, TOGETHER):
                    yield rows(some)

    done = claimed.select("task_id", "payload_json", "attempts").mapInPandas(run, ATTEMPTS)
    broken = violations(parsed(F.col("raw_response")), F.col("raw_response"))
    judged = done.withColumn("_v", F.when(F.col("error").isNull(), broken).otherwise(F.array().cast("array<string>")))
    ok = F.col("error").isNull() & (F.size("_v") == 0)
    columns = [c.split()[0] for c in ATTEMPTS.split(", ")]
    return judged.withColumns({
        "status": F.when(ok, "succeeded").when(F.col("error") == RELEASED, "released").otherwise("failed"),
        "result_json": F.when(ok, json_object(F.col("raw_response"))),
        "error": F.coalesce("error", F.when(F.size("_v") > 0, F.concat(F.lit("ValidationError: "), F.array_join("_v", ", ")))),
    }).select(*columns)
