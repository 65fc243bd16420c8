"""Language-model scoring with a subword lattice.

A text is a chain of pieces of an existing vocabulary that ends with an end symbol. `score` is the log10 probability of
the text under that model, all segmentations together: the log-space forward recursion over the piece lattice gives
each token's marginal Z, and as a piece that starts a word ends the one before it, the text's marginal is the product
of its tokens' and of the end's, so Z is a probability distribution over tokens.

A piece's probability is `ADAPT` parts what expectation maximisation (one step over all distinct training tokens, each
as often as it occurs) expects of it, and the rest the vocabulary's own score; the end's is its share of all symbols.

`mixed_score` beside it is a model of whole tokens with the lattice for what they leave open:

    P(token) = (1 - m) * count / N + m * Z(token)

m, the mass of the lattice, is the share of training tokens seen once (Good-Turing).

Counts are exact over all training rows. The most frequent `HEAD` tokens (a fixed number) are sent to
every worker; each text's other tokens are joined with the full table of counts, so nothing that grows
with the corpus is held in one place.

Defined cases: null text is empty; an empty text has one token, its end; without training rows, N is zero, pieces have the
vocabulary's scores and m is one; a null doc_id is hashed as the empty string; repeated rows
each count and are each returned; other columns are ignored, whatever they are called.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_of, checkpointed, slices, texts_of
from .pieces import SPACE, Lattice, Vocabulary, distinct
from .sentencepiece_sampling import table_of

#: Most frequent tokens that every worker holds, at most.
HEAD = 150_000
#: Weight of the training corpus against the vocabulary's own scores in a piece's probability.
ADAPT = 0.5
SLICE = 4 << 20
#: White space of a text: separates tokens.
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(index into the distinct tokens, tokens of each text, bytes of the distinct ones, their starts); ends are left out."""
    lowered = [t.lower() for t in texts]  # for bytes: A-Z only
    data = np.frombuffer(b"\n".join(lowered) + b"\n", np.uint8)
    white = _WHITE[data]
    start = np.flatnonzero(~white & np.r_[True, white[:-1]])
    end = np.flatnonzero(white & ~np.r_[True, white[:-1]])
    limits = np.cumsum([len(t) + 1 for t in lowered])
    per_text = np.diff(np.r_[0, np.searchsorted(start, limits)])
    # tokens one after the other, without the white space
    keep = ~white
    starts = np.r_[0, np.cumsum(end - start)]
    which, body, body_starts = distinct(data[keep], starts)
    return which, per_text, body, body_starts


def as_strings(body: np.ndarray, starts: np.ndarray):
    import pyarrow as pa

    return pa.Array.from_buffers(pa.string(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(body))])


def marked(body: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lattice bytes of tokens: a space in front of each."""
    n = len(starts) - 1
    out = np.full(len(body) + n, SPACE, np.uint8)
    out[np.arange(len(body)) + np.repeat(np.arange(1, n + 1), np.diff(starts))] = body
    return out, starts + np.arange(n + 1)


def log_z(vocabulary: Vocabulary, body: np.ndarray, starts: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """Natural log of Z for each token, a slice at a time."""
    out = np.empty(len(starts) - 1)
    for a, b in slices(np.diff(starts), 1 << 19):
        data, at = marked(body[starts[a] : starts[b]], starts[a : b + 1] - starts[a])
        out[a:b] = Lattice(table_of(vocabulary), data, at, logp).log_marginal()
    return out


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, n) over the column `text`; the empty token is the end."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            column = batch.column(0)
            sizes = column.cast(pa.binary()).fill_null(b"")
            for a, b in slices(np.diff(np.frombuffer(sizes.buffers()[1], np.int32)[sizes.offset : sizes.offset + len(sizes) + 1]), SLICE):
                which, _, body, starts = tokens(texts_of(column.slice(a, b - a)))
                n = np.bincount(which, minlength=len(starts) - 1)
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([as_strings(body, starts), pa.array([""])]), pa.array(np.r_[n, b - a].astype(np.int64))], ["token", "n"])

    return texts.select("text").mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def expected_uses(counts: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Expected uses of each piece over all counted tokens, under the vocabulary's scores."""
    size = len(vocabulary.pieces)
    shared = counts.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches) -> Iterator:
        import pyarrow as pa

        table, total = table_of(shared.value), np.zeros(size)
        for batch in batches:
            words, n = texts_of(batch.column(0)), batch.column(1).to_numpy().astype(float)
            for a, b in slices(np.fromiter(map(len, words), np.int64, len(words)), 1 << 20):
                data, at = marked(np.frombuffer(b"".join(words[a:b]), np.uint8), np.r_[0, np.cumsum([len(w) for w in words[a:b]])])
                total += Lattice(table, data, at).expected(n[a:b], size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["piece", "uses"])

    uses = counts.where("token != ''").mapInArrow(run, "piece int, uses double").groupBy("piece").agg(F.sum("uses").alias("uses"))
    total = np.zeros(size)
    for piece, n in uses.collect():  # a row for each piece of the vocabulary at most
        total[piece] = n
    return total


def adapted(uses: np.ndarray, ends: int, vocabulary: Vocabulary, weight: float = ADAPT) -> tuple[np.ndarray, float]:
    """Log-probabilities of the pieces and of the end, which together sum to one."""
    own = np.where(np.isfinite(vocabulary.logp), np.exp(vocabulary.logp), 0.0)
    share = weight * uses / uses.sum() + (1 - weight) * own if uses.sum() else own
    end = (ends + 0.5) / (ends + uses.sum() + 1.0)
    with np.errstate(divide="ignore"):
        return np.log(share) + math.log(1 - end), math.log(end)


def most_frequent(counts: DataFrame, head: int) -> pd.DataFrame:
    """At most `head` rows of `counts`: those above the lowest sixteenth of a binary order of magnitude that leaves no more."""
    bins = F.floor(F.log2("n") * 16).cast("int").alias("bin")
    kept, least = 0, None
    for r in sorted(counts.groupBy(bins).agg(F.count("*").alias("tokens")).collect(), reverse=True):  # a thousand bins at most
        kept += r.tokens
        if kept > head:
            break
        least = r.bin
    return counts.where(F.lit(False) if least is None else F.floor(F.log2("n") * 16) >= least).toPandas().sort_values("token", ignore_index=True)


def scores(docs: DataFrame, vocabulary: Vocabulary, modulus: int = 5, held: int = 1, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, mixed_score) of every document."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("held_out", bucket_of(F.col("doc_id"), modulus) == held)
    counts = checkpointed(token_counts(docs.where("not held_out")))
    is_end = F.col("token") == ""
    n, v, once, ends = (int(x or 0) for x in counts.agg(F.sum("n"), F.count("*"), F.sum(F.when((F.col("n") == 1) & ~is_end, 1)), F.sum(F.when(is_end, F.col("n")))).first())
    m = min(0.999, max(once, 1) / n) if n else 1.0
    logp, log_end = adapted(expected_uses(counts, vocabulary), ends, vocabulary)
    top = most_frequent(counts, head)
    top = top[top.token != ""]
    words = [w.encode() for w in top.token]
    body, starts = np.frombuffer(b"".join(words), np.uint8), np.r_[0, np.cumsum([len(w) for w in words])].astype(np.int64)
    base = lambda c: np.log10((np.asarray(c, float) + 0.5) / (n + 0.5 * (v + 1)))
    own = lambda c, z: np.log10((1 - m) * np.asarray(c, float) / n + m * np.exp(np.asarray(z)))  # noqa: E731  counts above zero, so long tokens do not underflow
    top_z = log_z(vocabulary, body, starts, logp) if len(words) else np.zeros(0)
    known = {"token": top.token.tolist(), "base": base(top.n), "own": own(top.n, top_z) if len(words) else np.zeros(0), "z": top_z}
    end_base, end_own = float(base(ends)), math.log10((1 - m) * ends / n if n and ends else 0.5 / (n + 1))
    shared = docs.sparkSession.sparkContext.broadcast((known, vocabulary, logp))  # bounded by `head` and the vocabulary file

    def run(batches) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        known, vocabulary, logp = shared.value
        table = pa.array(known["token"], pa.string())
        for batch in batches:
            column = batch.column(2)
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            for a, b in slices(sizes, SLICE):
                which, per_text, body, starts = tokens(texts_of(column.slice(a, b - a)))
                strings = as_strings(body, starts)
                at = pc.index_in(strings, table).fill_null(-1).to_numpy(zero_copy_only=False)
                rare = at < 0
                token_base = np.where(rare, 0.0, np.r_[known["base"], 0.0][at])
                token_own = np.where(rare, 0.0, np.r_[known["own"], 0.0][at])
                text = np.repeat(np.arange(b - a), per_text)
                z = np.where(rare, 0.0, np.r_[known["z"], 0.0][at])
                left = np.flatnonzero(rare)
                sub = np.repeat(rare, np.diff(starts))
                z[left] = log_z(vocabulary, body[sub], np.r_[0, np.cumsum(np.diff(starts)[left])], logp)
                sums = [np.bincount(text, x[which], b - a) for x in (token_base, token_own, ~rare, z)]
                # the others: (text, token) with how often, ordered by text
                lean = rare[which]
                pair, times = np.unique(text[lean] * np.int64(len(rare)) + which[lean], return_counts=True)
                doc, token = pair // max(1, len(rare)), pair % max(1, len(rare))
                offsets = pa.array(np.searchsorted(doc, np.arange(b - a + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, x) for x in (strings.take(pa.array(token)), pa.array(times.astype(np.int32)), pa.array(z[token]))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(per_text + 1), pa.array(sums[2].astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]), pa.array(sums[3]), *lists],
                    ["doc_id", "held_out", "n_tokens", "known", "base", "own", "marginal", "token", "times", "z"],
                )

    schema = "doc_id long, held_out boolean, n_tokens long, known long, base double, own double, marginal double, token array<string>, times array<int>, z array<double>"
    parts = docs.select("doc_id", "held_out", "text").mapInArrow(run, schema)
    parts = parts.withColumn("token", F.array_join("token", " "))  # tokens hold no space: smaller to keep
    parts = checkpointed(parts.withColumn("row", F.monotonically_increasing_id()))
    rare = parts.where("size(times) > 0").select("row", F.explode(F.arrays_zip(F.split("token", " ").alias("token"), "times", "z")).alias("x")).select("row", F.col("x.token").alias("token"), "x.times", "x.z")
    c = F.coalesce(F.col("n"), F.lit(0))
    own_sql = F.when(c > 0, F.log10((1 - m) * c / F.lit(float(max(n, 1))) + m * F.exp("z"))).otherwise(F.col("z") / math.log(10) + math.log10(m))
    sums = rare.join(counts, "token", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10((c + 0.5) / F.lit(n + 0.5 * (v + 1)))).alias("more_base"),
        F.sum(F.col("times") * own_sql).alias("more_own"),
        F.sum(F.when(c > 0, F.col("times"))).alias("more_known"),
    )
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    return parts.drop("token", "times", "z").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + (1 if ends else 0) + zero("more_known")).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + end_base + zero("more_base")).alias("base_score"),
        ((F.col("marginal") + log_end) / math.log(10)).alias("score"),
        (F.col("own") + end_own + zero("more_own")).alias("mixed_score"),
    )
