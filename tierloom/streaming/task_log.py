"""The resumable task run: tasks and the attempts log as folders of Parquet, advanced in micro-batches.

New task files arrive as a stream; the checkpoint remembers which were read, so a run that was stopped goes on where it
stood. Each batch is classified and its attempts are appended; an attempt is named by task and number, so a batch that
runs twice after a failure adds nothing.
"""

from __future__ import annotations

import fcntl
import os
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor, wait
from contextlib import contextmanager
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.classify import run_classifier
from ..operators.tasks import ATTEMPTS, claim, latest_state, progress
from ..sources.sinks import append, write_json

CLAIMS = "task_id string, attempt int, claimed_at string"
TASKS = "dataset_id string, source_row_number int, patent_id string, keyword_level string, selection_group string, selection_probability double, sample_weight double, payload_json string, task_id string"


class TaskLog:
    def __init__(self, spark: SparkSession, folder: str, max_attempts: int = 3):
        self.spark, self.folder, self.max_attempts = spark, Path(folder), max_attempts

    @property
    def tasks(self) -> DataFrame:
        return self.spark.read.schema(TASKS).parquet(f"{self.folder}/tasks")

    @property
    def attempts(self) -> DataFrame:
        path = self.folder / "attempts"
        return self.spark.read.schema(ATTEMPTS).parquet(str(path)) if path.exists() else self.spark.createDataFrame([], ATTEMPTS)

    @property
    def claims(self) -> DataFrame:
        path = self.folder / "claims"
        return self.spark.read.schema(CLAIMS).parquet(str(path)) if path.exists() else self.spark.createDataFrame([], CLAIMS)

    def state(self) -> DataFrame:
        return latest_state(self.tasks, self.attempts, self.max_attempts, self.claims)

    @contextmanager
    def owned(self) -> Iterator[None]:
        """Only one runner at a time."""
        self.folder.mkdir(parents=True, exist_ok=True)
        with open(self.folder / "runner.lock", "a+") as lock:
            try:
                fcntl.flock(lock, fcntl.LOCK_EX | fcntl.LOCK_NB)
            except BlockingIOError:
                raise RuntimeError(f"another runner works in {self.folder}") from None
            lock.truncate(0)
            lock.write(str(os.getpid()))
            lock.flush()
            yield

    def _attempt(self, ready: DataFrame, classify: Callable, model: str, workers: int, stop: Callable[[], bool] = lambda: False) -> None:
        """Claims are written before any call is made, outcomes after; a stop in between is passed on to the workers within a tenth of a second."""
        marker = self.folder / "stopping"
        marker.unlink(missing_ok=True)
        append(ready.select("task_id", (F.col("attempts") + 1).cast("int").alias("attempt"), F.lit(datetime.now(UTC).isoformat()).alias("claimed_at")), str(self.folder / "claims"))
        with ThreadPoolExecutor(1) as own:
            job = own.submit(append, run_classifier(ready, classify, model, workers, str(marker)), str(self.folder / "attempts"))
            while not job.done():
                if stop():
                    marker.touch()
                wait([job], 0.1)
            marker.unlink(missing_ok=True)
            job.result()

    def waiting(self, delay: float) -> DataFrame:
        """Tasks whose last attempt ended less than `delay` seconds ago."""
        edge = datetime.fromtimestamp(time.time() - delay, UTC).isoformat()
        return self.attempts.where(F.col("finished_at") > edge).select("task_id").distinct()

    def run(self, classify: Callable[[dict], dict], model: str = "", workers: int = 1, batch: int = 1_000, retry_delay: float = 0.0, stop: Callable[[], bool] = lambda: False, ahead: int = 50) -> None:
        """Batches of what is pending, strongest tiers first, until nothing is or `stop` says so. A failed task waits `retry_delay` seconds while others go on.

        The state is worked out once for `ahead` batches, of which the driver holds ids; payloads go from the task files to
        the workers. Progress is written after each batch.
        """
        with self.owned():
            while not stop():
                state = self.state()
                ready = claim(state, batch * ahead, self.max_attempts, self.waiting(retry_delay) if retry_delay else None)
                ids = ready.select("task_id", "attempts").collect()  # `ahead` batches of ids at most
                for a in range(0, len(ids), batch):
                    if stop():
                        break
                    some = self.spark.createDataFrame(ids[a : a + batch], "task_id string, attempts int")
                    self._attempt(self.tasks.select("task_id", "payload_json").join(F.broadcast(some), "task_id"), classify, model, workers, stop)
                    self.write_progress(workers)
                if not ids:
                    if claim(state, 1, self.max_attempts).isEmpty():
                        break
                    time.sleep(0.1)

    def run_serial(self, classify: Callable[[dict], dict], model: str = "", retry_delay: float = 0.0, stop: Callable[[], bool] = lambda: False) -> None:
        """One call at a time; a task that failed is tried again after the delay, before any other."""
        with self.owned():
            while not stop() and (next_ := claim(self.state(), 1, self.max_attempts).select("task_id", "payload_json", "attempts").collect()):
                one = self.spark.createDataFrame(next_, "task_id string, payload_json string, attempts int")
                self._attempt(one, classify, model, 1, stop)
                self.write_progress(1)
                if self.attempts.where((F.col("task_id") == next_[0].task_id) & (F.col("status") == "succeeded")).isEmpty():
                    until = time.monotonic() + retry_delay
                    while time.monotonic() < until and not stop():
                        time.sleep(min(0.1, max(0.0, until - time.monotonic())))

    def stream(self, classify: Callable[[dict], dict], model: str = "", workers: int = 1) -> None:
        """The first attempt of every task file not yet seen, as a stream that stops when it has caught up."""

        def handle(batch: DataFrame, _: int) -> None:
            known = self.attempts.select("task_id").distinct()
            fresh = batch.join(known, "task_id", "left_anti").withColumn("attempts", F.lit(0))
            self._attempt(fresh, classify, model, workers)

        with self.owned():
            source = self.spark.readStream.schema(TASKS).parquet(f"{self.folder}/tasks")
            query = source.writeStream.foreachBatch(handle).option("checkpointLocation", f"{self.folder}/stream").trigger(availableNow=True).start()
            query.awaitTermination()
            self.write_progress(workers)

    def write_progress(self, workers: int = 1) -> None:
        rows = progress(self.state(), workers).collect()  # a row for each dataset
        write_json({r.dataset_id: r.asDict() for r in rows}, self.folder / "progress.json")


def progress_stream(attempts: DataFrame, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Attempts by window and status from a stream of the log; rows later than `late` are left out."""
    at = F.to_timestamp("finished_at")
    return attempts.withColumn("at", at).withWatermark("at", late).groupBy(F.window("at", window), "status").agg(F.count("*").alias("attempts"), F.sum("elapsed_seconds").alias("seconds"))
