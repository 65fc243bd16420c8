"""Reading multi-file tabular text: discovery, headers by alias, cells, identity."""

from __future__ import annotations

import csv
import io
import itertools
import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import cell, first_filled

# Canonical field and the headers that stand for it, in order.
ALIASES = {
    "stock_code": ("关联股票代码", "code"),
    "company_name": ("企业名称",),
    "company_location": ("企业注册地",),
    "listed_company_relation": ("与上市公司关系",),
    "stock_name": ("股票简称",),
    "industry": ("上市公司行业",),
    "market": ("上市板块",),
    "title": ("专利名称",),
    "patent_type": ("专利类型",),
    "applicant": ("申请人",),
    "applicant_type": ("申请人类型",),
    "applicant_address": ("申请人地址",),
    "applicant_region": ("申请人地区",),
    "applicant_city": ("申请人城市",),
    "applicant_district": ("申请人区县",),
    "application_number": ("申请号",),
    "application_date": ("申请日",),
    "application_year": ("申请年份",),
    "publication_number": ("公开公告号",),
    "publication_date": ("公开公告日",),
    "publication_year": ("公开公告年份",),
    "grant_number": ("授权公告号",),
    "grant_date": ("授权公告日",),
    "grant_year": ("授权公告年份",),
    "ipc": ("IPC分类号",),
    "main_ipc": ("IPC主分类号",),
    "inventor": ("发明人",),
    "abstract": ("摘要文本",),
    "claim": ("主权项内容",),
}
# Labels of the classification text, in order.
LABELS = {"title": "专利名称", "abstract": "摘要", "claim": "主权项", "ipc": "IPC分类号", "main_ipc": "IPC主分类号"}

_YEAR = re.compile(r"(?<!\d)(?:19|20)\d{2}(?!\d)")


def dataset_id(path: str | Path) -> str:
    """The first year standing alone in the file's stem, else its slug, else `dataset`."""
    stem = Path(path).stem
    if found := _YEAR.search(stem):
        return found[0]
    return re.sub(r"\W+", "-", stem.casefold()).strip("-") or "dataset"


def dataset_id_column(name: Column) -> Column:
    """`dataset_id` of a file name, as a column expression."""
    stem = F.regexp_replace(F.regexp_replace(name, r"^.*/", ""), r"(?<=.)\.[^.]*$", "")
    slug = F.regexp_replace(F.regexp_replace(F.lower(stem), r"(?U)\W+", "-"), "^-+|-+$", "")
    return first_filled(F.regexp_extract(stem, r"(?<![0-9])((?:19|20)[0-9]{2})(?![0-9])", 1), slug, F.lit("dataset"))


def collisions(files: DataFrame) -> DataFrame:
    """(dataset_id, paths) of ids that several paths of column `path` share."""
    ids = files.groupBy(dataset_id_column(F.col("path")).alias("dataset_id")).agg(F.array_sort(F.collect_set("path")).alias("paths"))
    return ids.where(F.size("paths") > 1)


def discover_files(explicit: Sequence[str | Path] = (), directory: str | Path | None = None, pattern: str = "*.csv") -> list[Path]:
    """Input files, the explicit ones or else those the pattern finds, ordered by dataset."""
    paths = [Path(p) for p in explicit] or (sorted(Path(directory).glob(pattern)) if directory else [])
    if missing := [p for p in paths if not p.is_file()]:
        raise FileNotFoundError(f"no such input: {', '.join(map(str, missing))}")
    if not paths:
        raise FileNotFoundError(f"no file in {directory} matches {pattern}")
    by_id: dict[str, list[Path]] = {}
    for p in paths:
        by_id.setdefault(dataset_id(p), []).append(p)
    if doubled := {k: v for k, v in by_id.items() if len(set(v)) > 1}:
        raise ValueError(f"several files for one dataset: {doubled}")
    return sorted(dict.fromkeys(paths), key=lambda p: (dataset_id(p), str(p)))


def canonical(raw: DataFrame, aliases: Mapping[str, Sequence[str]] = ALIASES) -> DataFrame:
    """Canonical string fields of a frame with original headers; unknown headers drop out, missing fields are empty."""
    headers = {re.sub(r"^﻿", "", c).strip(): c for c in raw.columns}  # of equal ones the last
    kept = [c for c in raw.columns if c in ("source_row_number", "dataset_id", "raw")]
    fields = [first_filled(*[cell(F.col(f"`{headers[a]}`")) for a in names if a in headers]).alias(field) for field, names in aliases.items()]
    return raw.select(*kept, *fields)


def read_records(spark: SparkSession, path: str | Path, encoding: str = "utf-8-sig", limit: int | None = None, include_raw: bool = False, aliases: Mapping[str, Sequence[str]] = ALIASES) -> DataFrame:
    """Records of one CSV file with exact record numbers (the header is 1; a blank line counts as an empty record), read in parallel.

    Spark's text reader splits the file, wherever it is kept. A quoted newline can only be told from a record's end by what
    came before, so a first pass says of each block how it ends and how many records begin in it, for both ways in which
    it can begin: at a record or inside quotes. These few numbers, put in order, give every block its first record number. A
    record that runs over a block's end is completed from the beginning of the next. A limit, or another encoding than
    UTF-8, is read as one stream, as `read_stream` does.
    """
    if limit is not None or encoding.lower().replace("_", "-") not in ("utf-8", "utf-8-sig"):
        return read_stream(spark, path, encoding, limit, include_raw, aliases)
    lines = spark.read.option("lineSep", "\n").text(str(path)).select("value", F.col("_metadata.file_block_start").alias("block"))
    found = sorted(lines.mapInPandas(_surveyed, "block long, open0 boolean, begun0 long, open1 boolean, begun1 long, head long, header string").collect())  # a row a block
    header = next((r.header for r in found if r.block == 0 and r.header is not None), None)
    schema = "source_row_number int, raw map<string,string>, " + ", ".join(f"{f} string" for f in aliases)
    if header is None:
        rows = spark.createDataFrame([], schema)
        return (rows if include_raw else rows.drop("raw")).withColumn("dataset_id", F.lit(dataset_id(path)))
    first, opened, inside, number = {}, {}, False, 1
    for r in found:
        first[r.block], opened[r.block] = number, inside
        number += r.begun1 if inside else r.begun0
        inside = r.open1 if inside else r.open0
    heads = {r.block: r.head for r in found if opened[r.block]}
    tails: dict[int, list[str]] = {}
    if heads:  # what lies before the first record of blocks that begin inside quotes: parts of a record each
        wanted = lines.where(F.col("block").isin(list(heads)))
        got = {r.block: list(r.lines) for r in wanted.mapInPandas(lambda parts: _heads(parts, heads), "block long, lines array<string>").collect()}
        order = [r.block for r in found]
        for k in range(len(order) - 2, -1, -1):
            if opened[order[k + 1]]:
                after = order[k + 1]
                whole = not (next(r for r in found if r.block == after).begun1)  # no record begins there: the record goes on
                tails[order[k]] = got.get(after, []) + (tails.get(after, []) if whole else [])
    shared = spark.sparkContext.broadcast((first, heads, tails, header))  # some numbers for each block, parts of records at its end

    def run(parts: Iterator) -> Iterator:
        first, heads, tails, header = shared.value
        names = next(csv.reader(io.StringIO(header + "\n", newline="")))
        at = {h.lstrip("\ufeff").strip(): i for i, h in enumerate(names)}
        for block, own in _by_block(parts):
            skipped = itertools.islice(own, heads.get(block, 0), None)
            text = (line + "\n" for line in itertools.chain(skipped, tails.get(block, ())))
            rows = enumerate(csv.reader(text), first[block])
            yield from _framed(((n, row) for n, row in rows if n > 1), at, aliases, include_raw)

    # a block in which no record begins has only its tail to skip
    idle = [r.block for r in found if opened[r.block] and not r.begun1]
    used = lines.where(~F.col("block").isin(idle)) if idle else lines
    records = used.mapInPandas(run, schema).withColumn("dataset_id", F.lit(dataset_id(path)))
    return records if include_raw else records.drop("raw")


def _by_block(parts: Iterator) -> Iterator[tuple[int, Iterator[str]]]:
    """(block, its lines) from frames (value, block) that hold blocks one after the other; a bare carriage return ends a line too."""
    rows = ((b, v) for part in parts for b, v in zip(part["block"].tolist(), part["value"].tolist()))
    for block, own in itertools.groupby(rows, key=lambda r: r[0]):
        bare = (v.removeprefix("\ufeff") if block == n == 0 else v for n, (_, v) in enumerate(own))  # a mark of the byte order opens the file
        yield block, (line for v in bare for line in (re.split("(?<=\r)(?!$)", v) if "\r" in v[:-1] else (v,)))


def _open_after(line: str, opened: bool) -> bool:
    """Whether a quoted field is open after a line, given whether one was before; what the csv module itself makes of it."""
    if '"' not in line:
        return opened
    return list(csv.reader([('"' if opened else "") + line + "\n", "end"]))[-1] != ["end"]


def _surveyed(parts: Iterator) -> Iterator:
    import pandas as pd

    for block, lines in _by_block(parts):
        open0, begun0, open1, begun1, head, header = False, 0, True, 0, 0, []
        for line in lines:
            if block == 0 and begun0 <= 1 and (open0 or not header):
                header.append(line)
            begun0 += not open0
            begun1 += not open1
            head += open1 and not begun1
            if open0 == open1:
                open0 = open1 = _open_after(line, open0)
            else:
                open0, open1 = _open_after(line, open0), _open_after(line, open1)
        yield pd.DataFrame([{"block": block, "open0": open0, "begun0": begun0, "open1": open1, "begun1": begun1, "head": head, "header": "\n".join(header) if block == 0 else None}])


def _heads(parts: Iterator, heads: dict[int, int]) -> Iterator:
    import pandas as pd

    for block, lines in _by_block(parts):
        yield pd.DataFrame([{"block": block, "lines": list(itertools.islice(lines, heads[block]))}])


def _framed(rows: Iterator[tuple[int, list[str]]], at: dict[str, int], aliases: Mapping[str, Sequence[str]], include_raw: bool) -> Iterator:
    """Frames of canonical records from (number, cells)."""
    import pandas as pd

    while some := list(itertools.islice(rows, 5000)):
        out = []
        for n, row in some:
            values = {f: next((v for a in names if a in at and at[a] < len(row) and (v := _cell(row[at[a]]))), "") for f, names in aliases.items()}
            raw = {h: row[i] if i < len(row) else "" for h, i in at.items()} if include_raw else None
            out.append({"source_row_number": n, "raw": raw, **values})
        yield pd.DataFrame(out)


def read_stream(spark: SparkSession, path: str | Path, encoding: str = "utf-8-sig", limit: int | None = None, include_raw: bool = False, aliases: Mapping[str, Sequence[str]] = ALIASES) -> DataFrame:
    """The same records read by one task as a stream, from a file that every worker sees under its path."""
    schema = "source_row_number int, raw map<string,string>, " + ", ".join(f"{f} string" for f in aliases)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for name in batch["path"]:
                with open(name, encoding=encoding, newline="") as file:
                    rows = csv.reader(file)
                    if (header := next(rows, None)) is not None:
                        at = {h.lstrip("\ufeff").strip(): i for i, h in enumerate(header)}
                        yield from _framed(enumerate(itertools.islice(rows, limit), 2), at, aliases, include_raw)

    records = spark.createDataFrame([(str(path),)], "path string").mapInPandas(run, schema).withColumn("dataset_id", F.lit(dataset_id(path)))
    return records if include_raw else records.drop("raw")


def _cell(value: str) -> str:
    value = value.strip()
    return value[2:-1].strip() if value.startswith('="') and value.endswith('"') else value


def read_records_parallel(spark: SparkSession, paths: Sequence[str | Path], aliases: Mapping[str, Sequence[str]] = ALIASES) -> DataFrame:
    """Records of many files; each file's header counts for itself."""
    return reduce(DataFrame.unionByName, [read_records(spark, p, aliases=aliases) for p in paths])


def patent_id(row: str = "source_row_number") -> Column:
    """Application, publication or grant number, else the row's own name."""
    return first_filled(F.col("application_number"), F.col("publication_number"), F.col("grant_number"), F.concat(F.lit("source-row-"), F.col(row).cast("string")))


def classification_text(labels: Mapping[str, str] = LABELS, mark: str = "：") -> Column:
    """Labelled lines of the fields that are not empty."""
    return F.concat_ws("\n", *[F.when(F.coalesce(F.col(f), F.lit("")) != "", F.concat(F.lit(label + mark), F.col(f))) for f, label in labels.items()])


def file_digests(spark: SparkSession, paths: Sequence[str | Path]) -> DataFrame:
    """(path, size, sha256) of files."""
    return spark.read.format("binaryFile").load([str(p) for p in paths]).select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
