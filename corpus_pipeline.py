"""A corpus pipeline over the operators of `tierloom.llm`; each stage reads what the one before it wrote.

Every stage takes (spark, docs, sf_dir), with docs in the columns of `documents` (others are carried along), and judges
all of them. All but the last return documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierloom.llm import decontamination, pii, quality, sentencepiece_sampling, simhash
from tierloom.llm.common import discarded, fresh, read, stored


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, learnt from the labelled ones among them."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: of the least doc_id (rows without one last), then of the least row key.

    A row is known by two hashes of all its columns and not by its doc_id, so rows that share an id or have none are
    judged each by its text. Groups are settled on narrow rows; the whole rows are then met once by their key.
    """
    k1, k2 = fresh("_k1", docs.columns), fresh("_k2", docs.columns)
    plain = lambda c, kind: F.to_json(F.struct(c)) if "map<" in kind else c  # noqa: E731  maps have no hash
    columns = [x for c, kind in docs.dtypes for x in (plain(F.col(f"`{c}`"), kind), F.col(f"`{c}`").isNull())]
    keyed = docs.withColumns({k1: F.xxhash64(*columns), k2: F.xxhash64(F.lit("second"), *columns)})
    lean = keyed.select("doc_id", "text", k1, k2)
    rows = simhash.near_duplicates(lean, carry=[k1, k2])
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc_id"), F.col(k1).alias(k1), F.col(k2).alias(k2))).alias("kept")
    kept = rows.groupBy("component").agg(first).select(f"kept.{k1}", f"kept.{k2}")
    met = keyed.join(kept, [k1, k2], "left_semi")
    # rows alike in every column are one: the first, whichever it is
    n = fresh("_n", [*docs.columns, k1, k2])
    once = met.withColumn(n, F.row_number().over(Window.partitionBy(k1, k2).orderBy(k1))).where(F.col(n) == 1)
    return once.select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    names = tuple(fresh(n, docs.columns) for n in ("_words", "_hit", "_items"))
    return decontamination.contaminated(docs, read(spark, sf_dir, "benchmark"), carry=docs.columns, names=names).where(F.col(names[1]) == 0).select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars counts the new text."""
    clean = pii.redacted(docs, pii.train(spark))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids, and whether they decode to the text again."""
    vocabulary = sentencepiece_sampling.default_vocabulary()
    coded = sentencepiece_sampling.decode(sentencepiece_sampling.encode(docs.select("doc_id", "text"), vocabulary), vocabulary)
    return coded.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "ids", F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


STAGES = [("quality_filter", quality_filter), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("personal_data", personal_data), ("pieces", pieces)]

ORACLE_SQL = None  # no SQL for SimHash classes, trained models or sampled pieces


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result but the last is kept as Parquet in the shared checkpoint folder until the next is written."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        made = stored(stage(spark, docs, sf_dir), name)
        discarded(docs)
        docs = made
    return STAGES[-1][1](spark, docs, sf_dir)
