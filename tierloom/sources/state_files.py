"""Task state kept in SQLite files by other tools, read into DataFrames."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

COLUMNS = "task_id string, dataset_id string, patent_id string, source_row_number int, keyword_level string, selection_group string, selection_probability double, sample_weight double, payload_json string, status string, attempts int, requested_model string, actual_model string, response_id string, result_json string, raw_response string, usage_json string, error string, elapsed_seconds double, created_at string, updated_at string, completed_at string"


def discover_state_files(folder: str | Path) -> list[Path]:
    return sorted(Path(folder).glob("classification_state_*.sqlite3"))


def read_state_files(spark: SparkSession, paths: Sequence[str | Path]) -> DataFrame:
    """All tasks of several files, ordered inside each by dataset and task; a damaged file is an error. One task reads one file, as a stream."""
    paths = [str(Path(p).resolve()) for p in paths]
    if not paths:
        raise ValueError("at least one state file is needed")
    if missing := [p for p in paths if not Path(p).is_file()]:
        raise FileNotFoundError(", ".join(missing))
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def run(batches) -> Iterator:
        import sqlite3

        import pandas as pd

        for batch in batches:
            for path in batch["path"]:
                db = sqlite3.connect(f"file:{path}?mode=ro", uri=True)
                try:
                    if (said := db.execute("PRAGMA integrity_check").fetchone()[0]) != "ok":
                        raise ValueError(f"{path}: {said}")
                    there = {r[1] for r in db.execute("PRAGMA table_info(tasks)")}
                    wanted = ", ".join(n if n in there else f"NULL AS {n}" for n in names)
                    rows = db.execute(f"SELECT {wanted} FROM tasks ORDER BY dataset_id, task_id")
                    while part := rows.fetchmany(5000):
                        yield pd.DataFrame(part, columns=names)
                finally:
                    db.close()

    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(len(paths)).mapInPandas(run, COLUMNS)


def manifest(spark: SparkSession, paths: Sequence[str | Path]) -> DataFrame:
    """(path, size, sha256, tasks) of state files."""
    from pyspark.sql import functions as F

    from .records import file_digests

    counts = [(str(Path(p).resolve()), read_state_files(spark, [p]).count()) for p in paths]
    digests = file_digests(spark, paths).withColumn("path", F.regexp_replace("path", "^file:/*", "/"))
    return digests.join(spark.createDataFrame(counts, "path string, tasks long"), "path")
