"""Classification tasks: selection, sampling, state and progress.

Tasks are an immutable table; every attempt is a row of an append-only log. The state of a task is what its latest
attempt says, so nothing is ever updated in place and a writer that runs twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import blake2b
from .routing import rank

RATE, SEED = 0.02, "step2-e-sample-v1"
#: The only fields that may leave for a classifier: nothing of the routing is among them.
PAYLOAD = ("title", "abstract", "claim", "ipc", "main_ipc")
ATTEMPTS = "task_id string, attempt int, status string, requested_model string, actual_model string, response_id string, result_json string, raw_response string, usage_json string, error string, elapsed_seconds double, prompt_version string, finished_at string"


def task_id(dataset: Column, patent: Column) -> Column:
    return F.concat(F.lit("patent-"), dataset, F.lit("-"), blake2b(F.concat_ws("|", dataset, patent), 12))


def uniform(seed: str, dataset: Column, patent: Column) -> Column:
    """A number in [0, 1) from the first eight bytes of BLAKE2b, as a double."""
    hexed = blake2b(F.concat_ws("|", F.lit(seed), dataset, patent), 8)
    high, low = F.conv(F.substring(hexed, 1, 8), 16, 10).cast("double"), F.conv(F.substring(hexed, 9, 8), 16, 10).cast("double")
    return (high * float(1 << 32) + low) / float(1 << 64)


def uniform_sha(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) from the first 13 hexadecimal digits of SHA-256, by built-in functions."""
    hexed = F.sha2(F.concat_ws("|", F.lit(seed), *[p.cast("string") for p in parts]).cast("binary"), 256)
    return F.conv(F.substring(hexed, 1, 13), 16, 10).cast("double") / float(1 << 52)


def strongest(rows: DataFrame) -> DataFrame:
    """One row for each dataset and patent: of the highest tier, the first of the source."""
    order = Window.partitionBy("dataset_id", "patent_id").orderBy(rank(F.col("keyword_level")).desc(), "source_row_number")
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def select_tasks(rows: DataFrame, rate: float = RATE, seed: str = SEED, draw: Column | None = None) -> DataFrame:
    """All unique S, W and R patents and a stable sample of the others, with group, probability and weight.

    A patent is taken at its strongest tier, so whoever has any of S, W, R is not among the others: one window
    does the work of a scan by tier and an anti join.
    """
    if not 0 < rate <= 1:
        raise ValueError("the rate must be in (0, 1]")
    best = strongest(rows)
    sampled = F.col("keyword_level") == "E"
    draw = uniform(seed, F.col("dataset_id"), F.col("patent_id")) if draw is None else draw
    # one branch over one window; nearly all rows are of the default tier, so hashing the others too costs next to nothing
    kept = best.where(~sampled | (draw < rate))
    probability = F.when(sampled, F.lit(float(rate))).otherwise(1.0)
    return kept.withColumns({"selection_group": F.when(sampled, "E_sample").otherwise(F.col("keyword_level")), "selection_probability": probability, "sample_weight": 1 / probability})


def population(rows: DataFrame) -> DataFrame:
    """(dataset_id, keyword_level, unique_patents) after precedence."""
    return strongest(rows).groupBy("dataset_id", "keyword_level").agg(F.count("*").alias("unique_patents"))


def payload(fields: tuple[str, ...] = PAYLOAD) -> Column:
    return F.to_json(F.struct(*[F.coalesce(F.col(f), F.lit("")).alias(f) for f in fields]))


def prepare_tasks(selected: DataFrame, records: DataFrame) -> DataFrame:
    """Selected rows with their payload, joined back on the source row."""
    keys = ["dataset_id", "source_row_number"]
    lean = records.select(*keys, payload().alias("payload_json"))
    chosen = selected.select(*keys, "patent_id", "keyword_level", "selection_group", "selection_probability", "sample_weight")
    return chosen.join(lean, keys).withColumn("task_id", task_id(F.col("dataset_id"), F.col("patent_id")))


def unmatched(selected: DataFrame, records: DataFrame) -> DataFrame:
    """Selected rows that the records lack: must be empty."""
    return selected.join(records, ["dataset_id", "source_row_number"], "left_anti")


def latest_state(tasks: DataFrame, attempts: DataFrame, max_attempts: int = 3, claims: DataFrame | None = None) -> DataFrame:
    """Tasks with status, attempts and the latest attempt's fields. A failed attempt leaves a task pending until none is left.

    An attempt counts from its claim (task_id, attempt) on: one that was interrupted, so that its end was never written, is
    used up, and a task whose last one was is `stuck`. A released claim, whose call was never made, does not count.
    """
    log = attempts.where("status <> 'released'").dropDuplicates(["task_id", "attempt"])
    fields = [c for c in log.columns if c not in ("task_id", "attempt", "elapsed_seconds")]
    last = log.groupBy("task_id").agg(F.max("attempt").alias("_ended"), F.sum("elapsed_seconds").alias("elapsed_seconds"), F.max_by(F.struct(*fields), "attempt").alias("_last"))
    last = last.select("task_id", "_ended", "elapsed_seconds", *[F.col(f"_last.{c}").alias(f"_{c}") for c in fields])
    if claims is not None:
        made = claims.join(attempts.where("status = 'released'").select("task_id", "attempt"), ["task_id", "attempt"], "left_anti")
        last = last.join(made.groupBy("task_id").agg(F.max("attempt").alias("_claimed")), "task_id", "full")
    last = last.withColumn("attempts", F.greatest("_ended", "_claimed") if claims is not None else F.col("_ended"))
    joined = tasks.join(last, "task_id", "left")
    status = F.when(F.col("_status") == "succeeded", "succeeded").when(F.col("_ended") >= max_attempts, "failed").otherwise("pending")
    rest = [F.col(f"_{c}").alias(c) for c in fields if c != "status"]
    return joined.select(*[c for c in tasks.columns], status.alias("status"), F.coalesce("attempts", F.lit(0)).alias("attempts"), F.coalesce("elapsed_seconds", F.lit(0.0)).alias("elapsed_seconds"), *rest)


def claim(state: DataFrame, k: int, max_attempts: int = 3, waiting: DataFrame | None = None) -> DataFrame:
    """The next k tasks: pending with attempts left, not waiting for a retry, strongest tier and first rows first."""
    ready = state.where((F.col("status") == "pending") & (F.col("attempts") < max_attempts))
    if waiting is not None:
        ready = ready.join(waiting.select("task_id"), "task_id", "left_anti")
    return ready.orderBy(rank(F.col("keyword_level")).desc(), "source_row_number", "task_id").limit(k)


def stuck(state: DataFrame, max_attempts: int = 3) -> DataFrame:
    """Pending tasks without attempts left: claimed for the last time and interrupted."""
    return state.where((F.col("status") == "pending") & (F.col("attempts") >= max_attempts))


def progress(state: DataFrame, workers: int = 1, by: tuple[str, ...] = ("dataset_id",)) -> DataFrame:
    """Counts, percentage, mean times and remaining seconds by dataset, in one aggregation."""
    is_ = lambda *s: F.col("status").isin(*s)
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    done = is_("succeeded", "failed")
    sums = state.groupBy(*by).agg(
        F.count("*").alias("total"), count(done).alias("completed"), count(is_("succeeded")).alias("succeeded"), count(is_("failed")).alias("failed"), count(is_("pending", "running")).alias("pending"),
        F.coalesce(F.sum("elapsed_seconds"), F.lit(0.0)).alias("_elapsed"), F.coalesce(F.sum("attempts"), F.lit(0)).alias("_attempts"),
        F.coalesce(F.avg(F.when(done, F.col("elapsed_seconds"))), F.lit(0.0)).alias("_task"),
        F.array_sort(F.collect_set("actual_model")).alias("actual_models"),
    )
    request = F.when(F.col("_attempts") > 0, F.col("_elapsed") / F.col("_attempts")).otherwise(0.0)
    task = F.when(F.col("_task") != 0, F.col("_task")).otherwise(request)
    return sums.select(
        *by, "total", "completed", "succeeded", "failed", "pending", "actual_models",
        F.round(F.col("completed") / F.col("total") * 100, 4).alias("progress_percent"),
        F.round(request, 3).alias("average_request_seconds"), F.round(task, 3).alias("average_completed_task_seconds"),
        F.when(task != 0, F.round(F.col("pending") * task / max(1, workers), 3)).alias("eta_seconds"),
    )
