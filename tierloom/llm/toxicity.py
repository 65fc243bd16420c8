"""Toxicity scoring with a counterfactually regularised classifier.

A logistic regression over capped counts of words and word prefixes. Besides the lasso it pays for every
change of score that swapping identity terms makes. In a labelled text, all mentions of each term it has are
swapped for every other term of the same language in turn; a text that has none gets one mention of each term of its own
language, which its most frequent function words tell (all terms where none does). Differences are those of the
capped counts that scoring reads. Their squares enter the loss, as the mean over replacements and over all
labelled texts, so neutral mentions of a group move the score as little as the data allow.

Features are chosen, and weights fitted, on labelled rows outside the held-out remainder, at most about
`SAMPLE` of them and `FEATURES` features; scoring is a single narrow pass.

Defined cases: null text is scored as empty; very long texts are read whole; without labelled rows, or with
one class only, every score is the smoothed share of that class (0.5 without any); repeated rows are scored
alike; a null doc_id is scored and never learnt from; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discarded, labelled_sample, slices, stored, texts_of
from .decontamination import word_ids

SAMPLE = 12_000
FEATURES = 6_000
TARGET, MODULUS, HELD = "toxic", 3, 1
LASSO, SWAP = 3e-4, 1.0
CAP = 3
THRESHOLD = 0.7
#: Bytes of a word that make a feature; 0 is the whole word.
PREFIXES = (0, 4, 6)
# Neutral words for groups of people, by language.
IDENTITY = {
    "en": "women men girls boys muslims christians jews hindus buddhists atheists immigrants refugees foreigners gays lesbians transgender disabled blind deaf elderly teenagers africans asians europeans latinos americans",
    "fr": "femmes hommes filles garçons musulmans chrétiens juifs hindous bouddhistes athées immigrés réfugiés étrangers homosexuels handicapés aveugles sourds africains asiatiques européens américains",
    "de": "frauen männer mädchen jungen muslime christen juden hindus buddhisten atheisten einwanderer flüchtlinge ausländer schwule lesben behinderte blinde gehörlose senioren afrikaner asiaten europäer amerikaner",
    "es": "mujeres hombres niñas niños musulmanes cristianos judíos hindúes budistas ateos inmigrantes refugiados extranjeros homosexuales lesbianas discapacitados ciegos sordos ancianos africanos asiáticos europeos americanos",
}
# Frequent function words, by language.
FUNCTION = {
    "en": "the of and to in is that for with was are this by from",
    "fr": "le la les des et est une dans pour que qui sur avec par",
    "de": "der die das und ist nicht mit ein eine von den auf sich dem",
    "es": "el los las de que y es una por con para del se como",
}


def _features(words, kind: int):
    """Feature strings of the distinct words for one prefix length."""
    import pyarrow.compute as pc

    return words if not kind else pc.binary_slice(words, 0, kind)


def _pieces(batches, column: int) -> Iterator:
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        texts = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(texts.cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
        for a, b in slices(sizes):
            yield batch.slice(a, b - a), *word_ids(texts_of(texts.slice(a, b - a)))


def _document_counts(rows: DataFrame) -> DataFrame:
    """(kind, feature, pos, neg): documents of either class with the feature."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch, which, first, words in _pieces(batches, 0):
            y = batch.column(1).to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(first))
            for kind in PREFIXES:
                code = _features(words, kind).dictionary_encode()
                n = len(code.dictionary)
                pairs = np.unique(doc * np.int64(n) + code.indices.to_numpy()[which]) if n else np.zeros(0, np.int64)
                pos = np.bincount(pairs % max(n, 1), y[pairs // max(n, 1)], n).astype(np.int64)
                total = np.bincount(pairs % max(n, 1), minlength=n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), code.dictionary, pa.array(pos), pa.array(total - pos)], ["kind", "feature", "pos", "neg"])

    counted = rows.select("text", "_y").mapInArrow(run, "kind int, feature binary, pos long, neg long")
    return counted.groupBy("kind", "feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _table(features: list[tuple[int, bytes]]) -> dict:
    """By kind: (feature strings, their numbers)."""
    return {k: ([f for kind, f in features if kind == k], np.array([i for i, (kind, _) in enumerate(features) if kind == k], np.int32)) for k in PREFIXES}


def _counts(table: dict, which: np.ndarray, first: np.ndarray, words, cap: int = CAP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, capped count) of the known features."""
    import pyarrow as pa
    import pyarrow.compute as pc

    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    docs, numbers = [], []
    for kind, (known, number) in table.items():
        if not known or not len(words):
            continue
        at = pc.index_in(_features(words, kind), pa.array(known, pa.binary())).fill_null(-1).to_numpy(zero_copy_only=False)[which]
        hit = at >= 0
        docs.append(doc[hit])
        numbers.append(number[at[hit]])
    if not docs:
        return (np.zeros(0, np.int64),) * 3
    pair, times = np.unique(np.concatenate(docs) * np.int64(1 << 32) + np.concatenate(numbers), return_counts=True)
    return pair >> 32, pair & 0xFFFFFFFF, np.minimum(times, cap)


def identity_terms() -> list[bytes]:
    """The distinct terms of all languages."""
    return list(dict.fromkeys(w.encode() for words in IDENTITY.values() for w in words.split()))


def votes(which: np.ndarray, first: np.ndarray, words) -> np.ndarray:
    """Function words of each language in each document."""
    import pyarrow as pa
    import pyarrow.compute as pc

    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out = np.zeros((len(first) - 1, len(FUNCTION)), np.int32)
    for k, own in enumerate(FUNCTION.values()):
        hit = pc.is_in(words, value_set=pa.array([w.encode() for w in own.split()], pa.binary())).to_numpy(zero_copy_only=False)[which] if len(words) else np.zeros(0, bool)
        out[:, k] = np.bincount(doc[hit], minlength=len(first) - 1)
    return out


def languages_of(vote: np.ndarray) -> np.ndarray:
    """Number of the language with the most function words, the first of equal ones; -1 without any."""
    return np.where(vote.sum(axis=1) > 0, vote.argmax(axis=1), -1) if len(vote) else np.zeros(0, int)


def swaps_of(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, language: np.ndarray, features: list[tuple[int, bytes]], cap: int = CAP) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """((swap, feature, difference), share of each swap) over all rows; equal differences are one swap with their shares added.

    `values` are counts without a cap; `language` has a number for each row.
    """
    n = len(language)
    number = {f: i for i, f in enumerate(features)}
    terms = [[w.encode() for w in own.split()] for own in IDENTITY.values()]
    marks = {t: [number[k, t[: k or None]] for k in PREFIXES] for own in terms for t in own}
    local = {f: i for i, f in enumerate(sorted({f for fs in marks.values() for f in fs}))}
    back = np.array(sorted(local))
    counts = np.zeros((n, len(local)), np.int64)
    known = np.isin(cols, back)
    np.add.at(counts, (rows[known], np.searchsorted(back, cols[known])), values[known].astype(np.int64))
    marks = {t: [local[f] for f in fs] for t, fs in marks.items()}
    out_swap, out_feature, out_value, share = [], [], [], []

    def put(at: np.ndarray, change: dict[int, np.ndarray], weight: float) -> None:
        """Rows `at` change by change[feature] each, before the cap."""
        places = sorted(f for f, c in change.items() if c.any())
        if not len(at) or not places:
            return
        before = counts[np.ix_(at, places)]
        delta = np.minimum(before + np.stack([change[f] for f in places], axis=1), cap) - np.minimum(before, cap)
        kinds, times = np.unique(delta, axis=0, return_counts=True)
        for d, k in zip(kinds, times):
            if d.any():
                out_swap.extend([len(share)] * int((d != 0).sum()))
                out_feature.extend(back[np.array(places)[d != 0]].tolist())
                out_value.extend(d[d != 0].tolist())
                share.append(k * weight / n)

    has = {t: counts[:, fs[0]] for t, fs in marks.items()}  # PREFIXES begins with the whole word
    some = np.zeros(n, bool)
    for t, mentions in has.items():
        some |= mentions > 0
        own = [k for k, words in enumerate(terms) if t in words]
        chosen = np.where(np.isin(language, own), language, own[0])
        for k in own:
            at = np.flatnonzero((mentions > 0) & (chosen == k))
            for u in terms[k]:
                if u != t:
                    change: dict[int, np.ndarray] = {f: np.zeros(len(at), np.int64) for f in (*marks[t], *marks[u])}
                    for f in marks[t]:
                        change[f] = change[f] - mentions[at]
                    for f in marks[u]:
                        change[f] = change[f] + mentions[at]
                    put(at, change, 1 / (len(terms[k]) - 1))
    for k in range(-1, len(terms)):
        at, own = np.flatnonzero(~some & (language == k)), terms[k] if k >= 0 else list(marks)
        for u in own:
            put(at, dict.fromkeys(marks[u], np.ones(len(at), np.int64)), 1 / len(own))
    return (np.array(out_swap, np.int64), np.array(out_feature, np.int64), np.array(out_value, float)), np.array(share)


class ToxicityModel:
    def __init__(self, features: list[tuple[int, bytes]], weights: np.ndarray, intercept: float):
        used = np.flatnonzero(weights)
        self.features, self.weights, self.intercept = [features[i] for i in used], weights[used], float(intercept)

    def log_odds(self, which: np.ndarray, first: np.ndarray, words, table: dict | None = None) -> np.ndarray:
        d, f, n = _counts(table or _table(self.features), which, first, words)
        return self.intercept + (np.bincount(d, self.weights[f] * n, len(first) - 1) if len(d) else 0.0) + np.zeros(len(first) - 1)


def fit(x: tuple, y: np.ndarray, size: int, swaps: tuple, share: np.ndarray, strength: float = SWAP, steps: int = 500) -> tuple[np.ndarray, float]:
    """Weights and intercept. x: (row, feature, value); swaps: (swap, feature, difference), each swap with its share."""
    rows, cols, values = x
    at, of, change = swaps
    n, k = len(y), len(share)
    p = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    w, b = np.zeros(size), float(np.log(p / (1 - p)))
    # scaled by both parts of the curvature, so that one step width suits all
    spread = np.sqrt(np.bincount(cols, values**2, size) / n + 8 * strength * np.bincount(of, change**2 * share[at], size)) + 1e-3
    v, d = values / spread[cols], change / spread[of]

    def pull(w: np.ndarray) -> np.ndarray:
        """Gradient of the swaps' mean square."""
        return 2 * strength * np.bincount(of, d * (share * np.bincount(at, d * w[of], k))[at], size)

    # largest curvature, by the power method
    q = np.random.default_rng(0).random(size)
    for _ in range(20):
        q = np.bincount(cols, v * np.bincount(rows, v * q[cols], n)[rows], size) / (4 * n) + pull(q)
        top = np.linalg.norm(q) + 1e-9
        q = q / top
    rate = 1 / (1.2 * top + 0.25)
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(np.bincount(rows, v * vw[cols], n) + vb))) - y
        new = vw - rate * (np.bincount(cols, v * r[rows], size) / n + pull(vw))
        new = np.sign(new) * np.maximum(np.abs(new) - rate * LASSO, 0)
        new_b = vb - rate * r.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = new + (t - 1) / t2 * (new - w), new_b + (t - 1) / t2 * (new_b - b)
        w, b, t = new, new_b, t2
    w = w / spread
    a, b = calibrated(np.bincount(rows, values * w[cols], n) + b, y, b)
    return a * w, b


def calibrated(z: np.ndarray, y: np.ndarray, intercept: float) -> tuple[float, float]:
    """Factor for the weights and new intercept that undo the penalties' shrinkage: logistic calibration with smoothed targets, by Newton steps."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    u = np.stack([z - intercept, np.ones(len(z))])
    c = np.array([1.0, intercept])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(c @ u, -50, 50)))
        g = u @ (p - target) + np.array([1e-3 * (c[0] - 1), 0])
        h = (u * (p * (1 - p))) @ u.T + np.diag([1e-3, 1e-6])
        step = np.linalg.solve(h, g)
        c = c - step * min(1.0, 2 / (np.abs(step).max() + 1e-9))
    return max(float(c[0]), 0.0), float(c[1])


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, text_col: str = "text", strength: float = SWAP) -> ToxicityModel:
    """`strength` weighs the swaps' penalty."""
    rows = labelled_sample(docs.select("doc_id", F.col(text_col).cast("string").alias("text")), labels, TARGET, MODULUS, HELD, most, ["text"])
    rows = stored(rows, "toxicity-sample")  # `most` rows; read several times, while the documents are read once
    pos, neg = rows.agg(F.sum("_y"), F.sum(1 - F.col("_y"))).first()
    pos, neg = int(pos or 0), int(neg or 0)
    if not pos or not neg:
        p = (pos + 0.5) / (pos + neg + 1)
        return ToxicityModel([], np.zeros(0), np.log(p / (1 - p)))
    share = (F.col("pos") + 0.5) / (pos + 1), (F.col("neg") + 0.5) / (neg + 1)
    # how much of the classes' difference a feature explains: the signed square root of the likelihood gain
    gain = F.abs(F.log(share[0] / share[1])) * F.abs(share[0] - share[1])
    chosen = _document_counts(rows).where("pos + neg >= 3").withColumn("gain", gain).orderBy(F.desc("gain"), "kind", "feature").limit(FEATURES).collect()
    known = dict.fromkeys((r.kind, bytes(r.feature)) for r in chosen)
    for words in IDENTITY.values():  # so that mentions can be weighed, and held to nothing
        for w in words.split():
            known |= dict.fromkeys((k, w.encode()[: k or None]) for k in PREFIXES)
    features = list(known)
    shared = docs.sparkSession.sparkContext.broadcast(_table(features))  # FEATURES and the identity terms

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch, which, first, words in _pieces(batches, 0):
            d, f, n = _counts(shared.value, which, first, words, 1 << 30)
            at = pa.array(np.searchsorted(d, np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(at, pa.array(x.astype(np.int32))) for x in (f, n)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(languages_of(votes(which, first, words)).astype(np.int32)), *lists], ["y", "language", "f", "n"])

    got = rows.select("text", "_y").mapInArrow(run, "y int, language int, f array<int>, n array<int>").collect()  # `most` rows of chosen features
    discarded(rows)
    got.sort(key=lambda r: (r.y, r.f, r.n))
    y = np.array([r.y for r in got], float)
    row = np.repeat(np.arange(len(got)), [len(r.f) for r in got])
    col = np.concatenate([np.array(r.f, np.int64) for r in got])
    val = np.concatenate([np.array(r.n, float) for r in got])
    swaps, share = swaps_of(row, col, val, np.array([r.language for r in got]), features)
    return ToxicityModel(features, *fit((row, col, np.minimum(val, CAP)), y, len(features), swaps, share, strength))


def scored(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score), the score from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES weights at most

    def run(batches) -> Iterator:
        import pyarrow as pa

        model = shared.value
        table = _table(model.features)
        for batch, which, first, words in _pieces(batches, 1):
            z = model.log_odds(which, first, words, table)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-z)))], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
