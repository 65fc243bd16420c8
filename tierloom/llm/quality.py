"""Quality classification with a sparse ensemble of rules.

Statistics of the whole text are column expressions. Shallow boosted trees over them give paths; each path
is a conjunctive rule. A lasso logistic regression weighs rules and standardised statistics, and those that
keep a weight are compiled into one Spark column expression. Fitting uses labelled rows outside the held-out
remainder, at most about `SAMPLE` of them; scoring is a single narrow pass over any number of rows.

Defined cases: null text is scored as empty; very long texts are read whole; without labelled rows, or with
one class only, every score is the smoothed share of that class (0.5 without any); repeated rows are scored
alike; a null doc_id is scored and never learnt from; other columns are ignored by the score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample, packed, text_of
from .trees import boost, paths, sigmoid

#: Labelled rows to learn from, at most about this many.
SAMPLE = 20_000
TARGET, MODULUS, HELD = "quality", 4, 2
ROUNDS, DEPTH = 24, 3
LASSO = 2e-3
THRESHOLD = 0.7


def statistics(text: Column) -> dict[str, Column]:
    """Statistics by name over the columns that `measured` adds."""
    chars, words, lines = F.col("_chars"), F.size("_words"), F.size("_lines")
    some = lambda n: F.greatest(n, F.lit(1)).cast("double")
    kept = lambda pattern: F.octet_length(F.regexp_replace(text, pattern, ""))
    return {
        "log_chars": F.log1p(chars.cast("double")),
        "upper": kept("[^A-Z]+") / some(chars),
        "symbols": (kept(r"[^\p{Punct}]+") - kept("[^,.]+")) / some(chars),
        "digits": kept("[^0-9]+") / some(chars),
        "commas_stops": kept("[^,.]+") / some(words),
        "word_length": chars / some(words),
        "distinct_words": F.size(F.array_distinct("_words")) / some(words),
        "line_length": chars / some(lines),
        "distinct_lines": F.size(F.array_distinct("_lines")) / some(lines),
        "words_by_line": words / some(lines),
        "short_words": F.size(F.filter("_words", lambda w: F.octet_length(w) <= 3)) / some(words),
    }


def measured(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(_row, _stats): the columns `keep` (or all) as a struct, and the statistics as another."""
    rows = docs.select(packed(docs, docs.columns if keep is None else keep), text_of(text_col).alias("_text"))
    parts = rows.withColumns({"_chars": F.length("_text"), "_words": F.split("_text", " "), "_lines": F.split("_text", "\n")})
    stats = F.struct(*[c.alias(n) for n, c in statistics(F.col("_text")).items()])
    # generated, not projected: the optimizer would copy a projected struct into every rule and filter that reads it
    return parts.select("_row", F.explode(F.array(stats)).alias("_stats"))


def lasso(x: np.ndarray, y: np.ndarray, strength: float, steps: int = 600) -> tuple[float, np.ndarray]:
    """(intercept, weights) of an L1-penalised logistic regression, by accelerated proximal gradient."""
    n, k = x.shape
    p = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    w, b = np.zeros(k), float(np.log(p / (1 - p)))
    rate = 4.0 * n / (np.linalg.norm(np.c_[x, np.ones(n)], 2) ** 2)
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(x @ vw + vb))) - y
        new = vw - rate * (x.T @ r) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rate * strength, 0)
        new_b = vb - rate * r.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = new + (t - 1) / t2 * (new - w), new_b + (t - 1) / t2 * (new_b - b)
        w, b, t = new, new_b, t2
    return b, w


class RuleEnsemble:
    """Weighted rules and statistics: [(weight, conditions)], [(weight, statistic, low, high, middle, scale)]."""

    def __init__(self, intercept: float, rules: list, linear: list):
        self.intercept, self.rules, self.linear = intercept, rules, linear

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> RuleEnsemble:
        if not len(y) or y.min() == y.max():
            p = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
            return cls(float(np.log(p / (1 - p))), [], [])
        _, trees = boost(x, y, ROUNDS, DEPTH, share=0.5, least=1.0)
        found = list(dict.fromkeys(p for tree in trees for p in paths(tree)))  # ROUNDS trees of DEPTH; the lasso chooses among all
        holds = np.stack([np.all([(x[:, f] > c) == above for f, above, c in p], axis=0) for p in found], axis=1).astype(float) if found else np.zeros((len(y), 0))
        low, high = np.quantile(x, 0.025, axis=0), np.quantile(x, 0.975, axis=0)
        clipped = np.clip(x, low, high)
        middle, scale = clipped.mean(axis=0), np.maximum(clipped.std(axis=0), 1e-9) / 0.4  # as spread out as a common rule
        b, w = lasso(np.c_[holds, (clipped - middle) / scale], y, LASSO)
        rules = [(float(v), p) for v, p in zip(w, found) if v]
        k = len(found)
        linear = [(float(w[k + f]), f, float(low[f]), float(high[f]), float(middle[f]), float(scale[f])) for f in range(x.shape[1]) if w[k + f]]
        return cls(float(b), rules, linear)

    def score(self, features: list[Column]) -> Column:
        total = F.lit(self.intercept)
        for weight, conditions in self.rules:
            holds = F.lit(True)
            for f, above, cut in conditions:
                holds = holds & ((features[f] > cut) if above else (features[f] <= cut))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        for weight, f, low, high, middle, scale in self.linear:
            total = total + weight * (F.least(F.greatest(features[f], F.lit(low)), F.lit(high)) - middle) / scale
        return sigmoid(total)


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, text_col: str = "text") -> RuleEnsemble:
    rows = labelled_sample(docs.select("doc_id", F.col(text_col).alias("text")), labels, TARGET, MODULUS, HELD, most, ["text"])
    rows = measured(rows, keep=["doc_id", "_y"]).select("_row.*", "_stats.*").toPandas()  # numbers only, `most` rows
    rows = rows.sort_values(list(rows.columns), kind="stable")
    return RuleEnsemble.fit(rows.drop(columns=["doc_id", "_y"]).to_numpy(float), rows["_y"].to_numpy(float))


def _score(frame: DataFrame, model: RuleEnsemble) -> Column:
    return model.score([F.col(f"_stats.{n}") for n in frame.schema["_stats"].dataType.names])


def scored(docs: DataFrame, model: RuleEnsemble, text_col: str = "text", keep: list[str] | None = None, out_col: str = "score") -> DataFrame:
    """`docs` (or its columns `keep`) with the score, from 0 to 1, in place of any column of its name."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != out_col]
    frame = measured(docs, text_col, keep)
    return frame.select("_row.*", _score(frame, model).alias(out_col))


def accepted(docs: DataFrame, model: RuleEnsemble, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that score `threshold` or more."""
    frame = measured(docs, text_col)
    return frame.where(_score(frame, model) >= threshold).select("_row.*")
