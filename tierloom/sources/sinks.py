"""Sinks: tiered tables, CSV sheets with a byte-order mark, JSON summaries written whole or not at all."""

from __future__ import annotations

import json
import os
import shutil
from pathlib import Path

from pyspark.sql import DataFrame


def write_tiers(rows: DataFrame, path: str, overwrite: bool = False, form: str = "parquet") -> None:
    """One directory for each dataset and tier, so that readers prune to the tier they want."""
    rows.write.partitionBy("dataset_id", "keyword_level").mode("overwrite" if overwrite else "errorifexists").format(form).options(**({"header": "true", "escape": '"'} if form == "csv" else {})).save(path)


def write_table(rows: DataFrame, path: str, overwrite: bool = False) -> None:
    rows.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def write_sheet(rows: DataFrame, path: str | Path, overwrite: bool = False) -> None:
    """One CSV file with a byte-order mark, in the frame's order; rows pass the driver one at a time. Meant for samples."""
    import csv

    path = Path(path)
    if path.exists() and not overwrite:
        raise FileExistsError(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_suffix(path.suffix + ".part")
    with part.open("w", encoding="utf-8-sig", newline="") as file:
        out = csv.writer(file)
        out.writerow(rows.columns)
        for row in rows.toLocalIterator():
            out.writerow(["" if v is None else v for v in row])
    os.replace(part, path)


def write_json(value: dict, path: str | Path) -> None:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_suffix(path.suffix + ".part")
    part.write_text(json.dumps(value, ensure_ascii=False, indent=2, default=str) + "\n", encoding="utf-8")
    os.replace(part, path)


def read_json(path: str | Path) -> dict | None:
    path = Path(path)
    return json.loads(path.read_text(encoding="utf-8")) if path.is_file() else None


def clear(path: str | Path) -> None:
    path = Path(path)
    shutil.rmtree(path) if path.is_dir() else path.unlink(missing_ok=True)
