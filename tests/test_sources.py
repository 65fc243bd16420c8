import json
import random

import pytest
from pyspark.sql import functions as F

from tierloom.functions import text
from tierloom.sources import records, sinks
from tierloom.sources.taxonomy import Taxonomy, load_sources, load_taxonomy, sample_taxonomy

HEADER = "关联股票代码,code,企业名称,专利名称,申请号,申请年份,IPC分类号,IPC主分类号,摘要文本,主权项内容,unknown"


def write(path, *lines, encoding="utf-8-sig"):
    path.write_text("\n".join(lines) + "\n", encoding=encoding)
    return path


def test_records_keep_numbers_aliases_and_cells(spark, tmp_path):
    p = write(tmp_path / "x_2021.csv", HEADER, ',"=""002121""",  Firm ,T1,CN1,2021,G06F 21/60,,"line one\nline ""two""",claim,zz', "", "s2,ignored,,T2", "s3,,,T3,CN3,2021,,,a,b,c,d,e")
    got = records.read_records(spark, p, include_raw=True).orderBy("source_row_number").collect()
    assert [r.source_row_number for r in got] == [2, 3, 4, 5]
    a, blank, short, long_ = got
    assert (a.stock_code, a.company_name, a.title, a.abstract, a.main_ipc) == ("002121", "Firm", "T1", 'line one\nline "two"', "")
    assert a.raw["code"] == '="002121"' and a.dataset_id == "2021"
    assert blank.title == "" and short.stock_code == "s2" and short.claim == "" and long_.claim == "b"
    assert [r.title for r in records.read_records(spark, p, limit=1).collect()] == ["T1"]
    assert records.read_records(spark, write(tmp_path / "empty.csv")).count() == 0


def test_parallel_reader_agrees_where_no_line_is_blank(spark, tmp_path):
    a = write(tmp_path / "a_2020.csv", HEADER, 's,,F,T1,CN1,2020,,,"x\ny",c,u', 't,,G,T2,CN2,2020,,,z,d,u')
    b = write(tmp_path / "b_2021.csv", "专利名称,申请号", "T3,CN3")
    got = {(r.dataset_id, r.source_row_number): r for r in records.read_records_parallel(spark, [a, b]).collect()}
    one = {(r.dataset_id, r.source_row_number): r for r in records.read_records(spark, a).collect()}
    assert {k for k in got if k[0] == "2020"} == set(one)
    for k, r in one.items():
        assert all(got[k][c] == r[c] for c in records.ALIASES)
    assert got["2021", 2].title == "T3" and got["2021", 2].abstract == ""


@pytest.mark.parametrize("block", [200, 700, 100_000])
def test_blocks_of_one_file_give_the_stream(spark, tmp_path, block):
    """Numbers, quoted newlines and quotes, blank lines and carriage returns, wherever a block ends."""
    rng = random.Random(block)
    cells = ["plain", "", '"two\nlines"', '"a ""quoted"" word, and\n\n more\nlines of it"', 'in"ch', '"long ' + "x" * 150 + "\n" + "y" * 150 + '"', '"q"tail', "数据安全"]
    lines = [",".join(rng.choice(cells) for _ in range(11)) for _ in range(120)]
    lines[7] = lines[50] = ""
    lines[20] += "\r"
    lines[30] = '"' + "\n".join(["z" * 90] * 12) + '",b,c'  # a record of more than several blocks
    p = write(tmp_path / "y_2020.csv", HEADER.replace("unknown", '"un\nknown"'), *lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = records.read_records(spark, p, include_raw=True)
        parts = got.rdd.getNumPartitions()
        rows = sorted(got.collect(), key=lambda r: r.source_row_number)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = records.read_stream(spark, p, include_raw=True).collect()
    assert rows == want and [r.source_row_number for r in rows] == list(range(2, 2 + len(rows)))
    assert parts > 3 or block > 10_000


def test_routing_of_one_file_is_spread(spark, tmp_path):
    from tierloom.plans import pipeline
    from tierloom.sources.taxonomy import sample_taxonomy

    p = write(tmp_path / "z_2021.csv", HEADER, *[f"s,,F,T{i},CN{i},2021,,,license {i},token," for i in range(60)])
    assert pipeline.step1(spark, p, str(tmp_path / "o"), sample_taxonomy())["S"] == 60
    assert len(list((tmp_path / "o/keyword_2021/dataset_id=2021/keyword_level=S").glob("*.parquet"))) > 1


def test_duplicate_headers_take_the_last(spark, tmp_path):
    p = write(tmp_path / "d.csv", "专利名称,专利名称", "first,last")
    assert records.read_records(spark, p).first().title == "last"


def test_cells_unwrap(spark):
    raw = ['="002"', '　="x "\t', '="', "plain", None, "﻿ ="]
    got = [r.c for r in spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "i int, v string").orderBy("i").select(text.cell(F.col("v")).alias("c")).collect()]
    assert got[:5] == ["002", "x", "", "plain", ""]


def test_dataset_ids(spark, tmp_path):
    names = {"patents_2021.csv": "2021", "a20211.csv": "a20211", "My File (x).csv": "my-file-x", "20201.1999.csv": "1999", "---.csv": "dataset"}
    assert {n: records.dataset_id(n) for n in names} == names
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", records.dataset_id_column(F.col("n")).alias("d"))
    assert {r.n: r.d for r in df.collect()} == names


def test_discovery(tmp_path):
    for n in ("b_2021.csv", "a_2020.csv"):
        (tmp_path / n).touch()
    assert [p.name for p in records.discover_files((), tmp_path)] == ["a_2020.csv", "b_2021.csv"]
    assert [p.name for p in records.discover_files([tmp_path / "b_2021.csv"], tmp_path)] == ["b_2021.csv"]
    (tmp_path / "c_2020.csv").touch()
    with pytest.raises(ValueError):
        records.discover_files((), tmp_path)
    for bad in (lambda: records.discover_files((), tmp_path, "*.nope"), lambda: records.discover_files([tmp_path / "none.csv"])):
        with pytest.raises(FileNotFoundError):
            bad()


def test_identity_and_text(spark):
    rows = [("A", "P", "G", 2), ("", "P", "G", 3), (None, "", "G", 4), ("", "", None, 5)]
    df = spark.createDataFrame(rows, "application_number string, publication_number string, grant_number string, source_row_number int")
    assert [r.i for r in df.select(records.patent_id().alias("i"), "source_row_number").orderBy("source_row_number").collect()] == ["A", "P", "G", "source-row-5"]
    one = spark.createDataFrame([("T", "", "C", None, "M")], "title string, abstract string, claim string, ipc string, main_ipc string")
    assert one.select(records.classification_text().alias("t")).first().t == "专利名称：T\n主权项：C\nIPC主分类号：M"


def test_normalisation_matches_python(spark):
    values = ["ＡＢＣ　x\t y", "Straße ẞ İ", " a\n b ", None, "ﬁ①"]
    got = [r.n for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").orderBy("i").select(text.normalize_text(F.col("v")).alias("n")).collect()]
    assert got == [text.normalized(v) for v in values]
    assert got[0] == "abc x y" and got[1].startswith("strasse ss") and got[2] == "a\n b" and got[3] == ""


def test_text_hash_and_floats(spark):
    one = spark.createDataFrame([("专利0", "摘要0", "主权项0", 1.0, 1 / 3, 50.0)], "t string, a string, c string, x double, y double, z double")
    r = one.select(text.text_hash(F.col("t"), F.col("a"), F.col("c")).alias("h"), *[text.format_float(F.col(c)).alias(c) for c in "xyz"]).first()
    assert r.h == "856e6e675a95fb5a177624c33e609e50f635b9c40c9e49ba684b452eae7ff90c"
    assert (r.x, r.y, r.z) == ("1", "0.333333333333", "50")


def test_sinks_write_whole_or_not(spark, tmp_path):
    df = spark.createDataFrame([("2020", "S", "x"), ("2020", "E", "y")], "dataset_id string, keyword_level string, v string")
    sinks.write_tiers(df, str(tmp_path / "t"))
    assert (tmp_path / "t/dataset_id=2020/keyword_level=S").is_dir()
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_tiers(df, str(tmp_path / "t"))
    sinks.write_sheet(df.orderBy("v"), tmp_path / "s.csv")
    assert (tmp_path / "s.csv").read_bytes().startswith(b"\xef\xbb\xbf") and "2020,S,x" in (tmp_path / "s.csv").read_text()
    with pytest.raises(FileExistsError):
        sinks.write_sheet(df, tmp_path / "s.csv")
    sinks.write_json({"中": 1}, tmp_path / "j.json")
    assert json.loads((tmp_path / "j.json").read_text()) == {"中": 1} and "中" in (tmp_path / "j.json").read_text()
    digests = records.file_digests(spark, [tmp_path / "j.json"]).first()
    assert digests.size == (tmp_path / "j.json").stat().st_size and len(digests.sha256) == 64


def test_taxonomy_integrity(tmp_path):
    t = sample_taxonomy()
    (tmp_path / "terms.json").write_text(json.dumps(t.docs), encoding="utf-8")
    (tmp_path / "codes.json").write_text(json.dumps(t.ipc), encoding="utf-8")
    (tmp_path / "s.json").write_text('{"sources": [{"id": "SRC-1"}]}', encoding="utf-8")
    assert load_taxonomy(tmp_path / "terms.json", tmp_path / "codes.json") == t and load_sources(tmp_path / "s.json") == {"SRC-1"}
    assert t.version == "docs-0.1__ipc-0.1" and t.window == 48 and "the" not in t.terms
    assert t.problems({"SRC-1"}) == []
    assert t.problems(set())
    twice = Taxonomy({**t.docs, "term_groups": [*t.docs["term_groups"], {**t.docs["term_groups"][0], "id": "S-2"}]}, t.ipc)
    assert len(twice.problems()) == 2
    with pytest.raises(ValueError):
        Taxonomy(t.docs, {"rules": [{"symbol": "nonsense", "match": "exact"}]}).rules
