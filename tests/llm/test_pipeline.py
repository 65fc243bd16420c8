import random

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from tierloom.llm import sentencepiece_sampling
from tierloom.llm.pieces import from_pieces

from .fixtures import SCHEMA, WORDS
from .test_classifiers import made


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("pipeline"))
    docs, labels = made(500)
    rng = random.Random(9)
    base = rng.choices(WORDS, k=900)
    near = [*base]
    near[450] = "changed"
    docs += [(10_000, " ".join(base), "en", "s", 1), (10_001, " ".join(near), "en", "s", 1), (10_002, " ".join(base), "en", "s", 1)]
    item = " ".join(rng.choices(WORDS, k=14))
    docs += [(10_003, " ".join(rng.choices(WORDS, k=60)) + " " + item + " " + " ".join(rng.choices(WORDS, k=40)), "en", "s", 1)]
    docs += [(10_004, " ".join(rng.choices(WORDS, k=80)) + " me@mail.example +1 (640) 555-0953 " + " ".join(rng.choices(WORDS, k=80)), "en", "s", 1)]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, docs, {i: q for i, q, _ in labels}


def test_stages_take_effect(spark, folder):
    d, docs, label = folder
    frame = spark.read.parquet(f"{d}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.stored(stage(spark, frame, d), name)
        assert frame.columns == SCHEMA.replace(",", "").split()[::2]
        seen[name] = {r.doc_id: r for r in frame.collect()}
    junk = {i for i, q in label.items() if not q}
    good = {i for i, q in label.items() if q}
    assert len(junk & set(seen["quality_filter"])) <= 0.03 * len(junk) and len(good & set(seen["quality_filter"])) >= 0.98 * len(good)
    assert 10_000 in seen["near_duplicates"] and not {10_001, 10_002} & set(seen["near_duplicates"])
    assert 10_003 in seen["near_duplicates"] and 10_003 not in seen["benchmark"] and 10_004 in seen["benchmark"]
    clean = seen["personal_data"][10_004]
    assert "[EMAIL] [PHONE]" in clean.text and clean.n_chars == len(clean.text)
    assert set(seen["personal_data"]) == set(seen["benchmark"])
    vocabulary = sentencepiece_sampling.default_vocabulary()
    last = corpus_pipeline.STAGES[-1][1](spark, frame, d).collect()
    assert len(last) == len(seen["personal_data"])
    for r in last:
        assert r.lossless and from_pieces(r.ids, vocabulary.pieces).decode() == seen["personal_data"][r.doc_id].text


def test_clashing_columns_and_odd_rows_pass_through(spark, folder):
    d, docs, _ = folder
    odd = [(None, None, None, None, None), (None, "no id " * 30, "en", "s", 1), (20_000, None, "en", "s", None), (20_001, "", "en", "s", 0), (20_002, "ta re mi so la ti do " * 3000, "en", "s", 1)]
    names = ("_score", "_n", "_hit", "items", "_base", "_stats", "_text", "_row", "_body", "_words", "token", "fp")
    frame = spark.createDataFrame(docs + odd + docs[:3], SCHEMA).withColumns({n: F.lit("mine") for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.stored(stage(spark, frame, d), name)
        assert frame.columns == [*SCHEMA.replace(",", "").split()[::2], *names]
        assert frame.where(" or ".join(f"{n} <> 'mine'" for n in names)).isEmpty()
    last = corpus_pipeline.STAGES[-1][1](spark, frame, d).collect()
    assert all(r.lossless for r in last) and len({r.doc_id for r in last if r.doc_id is not None}) == len([r for r in last if r.doc_id is not None])


def test_rows_that_share_an_id_or_have_none_are_judged_by_text(spark, folder):
    d, _, _ = folder
    rng = random.Random(4)
    a, b, c = (" ".join(rng.choices(WORDS, k=300)) for _ in range(3))
    rows = [(1, a, "en", "s", 1), (1, b, "en", "s", 1), (2, b, "en", "s", 1), (None, c, "en", "s", 1), (None, c, "en", "s", 1), (None, c, "fr", "s", 1), (None, a, "en", "s", 1), (3, None, "en", "s", None), (None, None, None, None, None), (3, "", "en", "s", 0)]
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), d).collect()))
    assert got == sorted([(False, 1, a), (False, 1, b), (True, 0, c), (False, 3, "")])


def test_run_keeps_no_files_of_earlier_stages(spark, folder):
    import os

    from tierloom.llm.common import shared_folder

    d, _, _ = folder
    there = lambda: {x for x in os.listdir(shared_folder(spark).removeprefix("file:")) if x.startswith(tuple(f"{n}-" for n, _ in corpus_pipeline.STAGES))}
    before = there()
    assert corpus_pipeline.run(spark, d).count()
    assert [x.split("-")[0] for x in there() - before] == ["personal_data"]


def test_stages_on_an_empty_table(spark, folder):
    d, _, _ = folder
    frame = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame, d).count() == 0


def test_run_equals_the_stages(spark, folder):
    d, _, _ = folder
    got = corpus_pipeline.run(spark, d)
    assert got.columns == ["doc_id", "text_sha256", "ids", "lossless"] and got.count() > 300
