"""Planning and evaluation measures that the method documents describe."""

from __future__ import annotations

from math import ceil, comb, exp, lgamma, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

Z = 1.96


def plan_sizes(n: int, years: int, design_effect: float = 1.0, error: float = 0.025, year_error: float = 0.05, floor_: int = 1500) -> dict[str, int]:
    """Sample sizes: finite-population correction, a minimum by year, core, risk and total."""
    n0 = Z**2 * 0.25 / error**2
    fpc = ceil(n0 / (1 + (n0 - 1) / n))
    by_year = ceil(Z**2 * 0.25 / year_error**2) * years
    core = min(n, ceil(design_effect * max(floor_, fpc, by_year)))
    risk = min(n - core, ceil(core / 3))
    return {"n_fpc": fpc, "n_year": by_year, "n_core": core, "n_risk": risk, "n_gold": core + risk}


def test_sizes(n_gold: int, years: int, recall: float = 0.90, width: float = 0.03, positive: float = 0.30) -> dict[str, int]:
    """Sizes of the locked test, development and training parts."""
    m = ceil(Z**2 * recall * (1 - recall) / width**2)
    test, dev = max(ceil(m / positive), 100 * years), max(400, ceil(0.2 * n_gold))
    return {"m_positive": m, "n_test": test, "n_dev": dev, "n_train": n_gold - test - dev}


test_sizes.__test__ = False


def weights(p_select: Column, p_draw: Column) -> Column:
    """Struct of the two-stage inclusion probability and the weight that undoes it."""
    p = p_select * p_draw
    return F.struct(p.alias("pi_total"), (1 / p).alias("w_full"))


def effective_n(weight: Column) -> Column:
    """Effective sample size of weights, as an aggregate."""
    return F.sum(weight) ** 2 / F.sum(weight * weight)


def grouped_split(rows: DataFrame, group: str, shares: dict[str, float], seed: str = "split-v1") -> DataFrame:
    """`rows` with the part of their group, by a hash of the group: members never part."""
    u = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(seed), F.col(group).cast("string")).cast("binary"), 256), 1, 13), 16, 10).cast("double") / float(1 << 52)
    part, low = F.lit(None).cast("string"), 0.0
    for name, share in shares.items():
        part = F.when((u >= low) & (u < low + share), name).otherwise(part)
        low += share
    return rows.withColumn("part", F.coalesce(part, F.lit(list(shares)[-1])))


def confusion(rows: DataFrame, truth: str, guess: str, by: tuple[str, ...] = (), weight: Column | None = None) -> DataFrame:
    return rows.groupBy(*by, truth, guess).agg(F.count("*").alias("n"), F.sum(F.lit(1.0) if weight is None else weight).alias("weight"))


def error_profile(rows: DataFrame, truth: str, guess: str, by: tuple[str, ...]) -> DataFrame:
    """Error rate by stratum."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.avg(F.when(F.col(truth) != F.col(guess), 1.0).otherwise(0.0)).alias("error_rate"))


def class_metrics(rows: DataFrame, truth: str, guess: str, weight: Column | None = None) -> DataFrame:
    """Weighted precision, recall and F1 of each class, in one pass: a row counts once as truth and once as guess."""
    w = F.lit(1.0) if weight is None else weight
    sides = rows.select(w.alias("w"), F.explode(F.array(F.struct(F.col(truth).alias("c"), F.lit(1).alias("t")), F.struct(F.col(guess).alias("c"), F.lit(0).alias("t")))).alias("x"), (F.col(truth) == F.col(guess)).alias("hit"))
    sums = sides.where("x.c is not null").groupBy(F.col("x.c").alias("class")).agg(*[F.sum(F.when(c, F.col("w")).otherwise(0.0)).alias(n) for n, c in (("true", F.col("x.t") == 1), ("guessed", F.col("x.t") == 0), ("right", (F.col("x.t") == 1) & F.coalesce("hit", F.lit(False))))])
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    p, r = ratio(F.col("right"), F.col("guessed")), ratio(F.col("right"), F.col("true"))
    return sums.select("class", "true", "guessed", p.alias("precision"), r.alias("recall"), ratio(2 * p * r, p + r).alias("f1"))


def macro_f1(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.avg("f1").alias("macro_f1"))


def rejection_rate(rows: DataFrame, guess: str) -> DataFrame:
    """Share of rows without a guess."""
    return rows.agg(F.avg(F.when(F.col(guess).isNull(), 1.0).otherwise(0.0)).alias("rejection_rate"))


def agreement(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Rows, agreement, conflict rate and Cohen's kappa of two annotators, from one table of counts."""
    cells = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))
    sides = cells.select("n", F.explode(F.array(F.struct(F.col("a").alias("c"), F.lit(0).alias("s")), F.struct(F.col("b").alias("c"), F.lit(1).alias("s")))).alias("x"), (F.col("a") == F.col("b")).alias("same"))
    by_class = sides.groupBy("x.c").agg(F.sum(F.when(F.col("x.s") == 0, F.col("n")).otherwise(0)).alias("na"), F.sum(F.when(F.col("x.s") == 1, F.col("n")).otherwise(0)).alias("nb"), F.sum(F.when((F.col("x.s") == 0) & F.col("same"), F.col("n")).otherwise(0)).alias("nn"))
    sums = by_class.agg(F.sum("na").alias("n"), F.sum("nn").alias("same"), F.sum(F.col("na") * F.col("nb")).alias("cross"))
    po, pe = F.col("same") / F.col("n"), F.col("cross") / (F.col("n").cast("double") * F.col("n"))
    return sums.select("n", po.alias("agreement"), (1 - po).alias("conflict_rate"), F.when(pe < 1, (po - pe) / (1 - pe)).otherwise(1.0).alias("kappa"))


def merged_annotations(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both annotators' sheets by sample, with why a sample goes to adjudication (null if it does not)."""
    side = lambda d, s: d.select("sample_id", F.col("human_cat").alias(f"cat_{s}"), F.col("human_review_state").alias(f"state_{s}"))
    both = side(a, "a").join(side(b, "b"), "sample_id", "full_outer")
    why = F.when(F.col("cat_a").isNull() | F.col("cat_b").isNull(), "missing").when(F.col("cat_a") != F.col("cat_b"), "category_conflict")
    why = why.when((F.col("cat_a") == 2) | (F.col("cat_b") == 2), "category_2").when(F.coalesce("state_a", F.lit("resolved")).isin("needs_adjudication", "unresolved") | F.coalesce("state_b", F.lit("resolved")).isin("needs_adjudication", "unresolved"), "review_state")
    return both.withColumn("conflict_type", why)


def without_leaks(candidates: DataFrame, gold: DataFrame, keys: tuple[str, ...] = ("patent_id", "family_id", "text_hash")) -> DataFrame:
    """Candidates that share no identifier, family or text with the gold rows."""
    for k in keys:
        if k in candidates.columns and k in gold.columns:
            candidates = candidates.join(gold.where(F.col(k).isNotNull()).select(k).distinct(), k, "left_anti")
    return candidates


def silver_grades(rows: DataFrame, high: float = 0.95, medium: float = 0.80, class_weight: Column | None = None) -> DataFrame:
    """Grades A to D and training weights from the calibrated chance `q` of being right."""
    grade = F.when(~F.col("evidence_valid") | F.col("anomalous"), "D").when((F.col("cat") == 2) | F.col("review_flag"), "C").when(F.col("q") >= high, "A").when(F.col("q") >= medium, "B").otherwise("C")
    w = F.lit(1.0) if class_weight is None else class_weight
    return rows.withColumn("grade", grade).withColumn("w_final", F.when(F.col("grade").isin("A", "B"), F.col("q") * F.col("q") * w).otherwise(0.0))


def calibrate(rows: DataFrame, score: str, label: str, method: str = "logistic"):
    """A fitted calibrator: rows in, rows with `calibrated` out."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    if method == "isotonic":
        model = IsotonicRegression(featuresCol=score, labelCol=label, predictionCol="calibrated").fit(rows)
        return model.transform
    assemble = VectorAssembler(inputCols=[score], outputCol="_x")
    model = LogisticRegression(featuresCol="_x", labelCol=label, probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_guess").fit(assemble.transform(rows))
    return lambda d: model.transform(assemble.transform(d)).withColumn("calibrated", vector_to_array("_p")[1]).drop("_x", "_p", "_raw", "_guess")


def poisson_weight(replicate: Column, key: Column, seed: str = "bootstrap-v1") -> Column:
    """A Poisson(1) draw by hash: a row's weight in one bootstrap replicate, the same wherever it is worked out."""
    u = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(seed), replicate.cast("string"), key.cast("string")).cast("binary"), 256), 1, 13), 16, 10).cast("double") / float(1 << 52)
    w, total, term = F.lit(0), 0.0, exp(-1)
    for k in range(8):
        total += term
        w = F.when(u >= total, F.lit(k + 1)).otherwise(w)
        term /= k + 1
    return w


def paired_bootstrap(rows: DataFrame, key: str, a: Column, b: Column, replicates: int = 200) -> DataFrame:
    """Mean difference of two measures over replicates: (replicate, difference). Each row is weighted in place, none is copied to a driver."""
    spread = rows.select(F.col(key).alias("_k"), a.alias("_a"), b.alias("_b")).withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    w = poisson_weight(F.col("replicate"), F.col("_k"))
    return spread.groupBy("replicate").agg((F.sum(w * (F.col("_a") - F.col("_b"))) / F.sum(w)).alias("difference"))


def mcnemar(rows: DataFrame, right_a: Column, right_b: Column) -> DataFrame:
    """Discordant counts and McNemar's statistic with continuity correction."""
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    counts = rows.agg(one(right_a & ~right_b).alias("only_a"), one(~right_a & right_b).alias("only_b"))
    n = F.col("only_a") + F.col("only_b")
    return counts.withColumn("statistic", F.when(n > 0, F.greatest(F.abs(F.col("only_a") - F.col("only_b")) - 1, F.lit(0)) ** 2 / n).otherwise(0.0))


def upper_bound(misses: int, n: int, confidence: float = 0.95) -> float:
    """Exact one-sided upper bound of a binomial proportion, by bisection."""
    if not n or misses >= n:
        return 1.0
    low, high = misses / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        tail = sum(exp(log(comb(n, k)) + k * log(p) + (n - k) * log(1 - p)) if n < 1000 else exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log(1 - p)) for k in range(misses + 1))
        low, high = (p, high) if tail > 1 - confidence else (low, p)
    return high


def certified(rows: DataFrame, miss: Column, limit: float, confidence: float = 0.95) -> tuple[bool, float]:
    """Whether the residual miss rate stays below a limit, and its upper bound."""
    m, n = rows.agg(F.sum(F.when(miss, 1).otherwise(0)), F.count("*")).first()
    bound = upper_bound(int(m or 0), int(n), confidence)
    return bound <= limit, bound


def share_within(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Each row's share of its group's total."""
    return rows.withColumn("share", F.col(value) / F.sum(value).over(Window.partitionBy(*by)))
