"""Sharding by sampled splitters.

Rows are ordered by a key (a hash of the text, then doc_id), so equal texts lie together. A sample of
keys, drawn with probability in proportion to size, gives quantile boundaries; rows are range-partitioned by
them, and ranges that turn out overfull, in bytes or in rows, are subdivided by a sample of their own. Exact
totals by range then place every row on the line of cumulated bytes, and shards are equal lengths of it. So
the sample decides how the work is spread; the shards do not depend on it.

The law is that shards are equal in bytes to within `TOLERANCE` of a shard. Inside it equal texts stay together: a group
of them that the tolerance can bear goes whole to the shard of its middle. Moving a heavier one whole would break the law,
so its rows are placed one by one, and a boundary may fall inside it: at most one for each boundary.

Random draws are hashes of the key, so a task that runs again draws the same. The driver holds the sample and
the ranges, both bounded by parameters; documents' keys are checkpointed without the text.

Defined cases: null text has no bytes (size 1); a null doc_id sorts first; repeated rows are each placed;
an empty table gives no rows; very long texts are read once for size and hashes; fewer rows than
shards leave shards empty; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, long_array

#: Ranges to aim at, at least, at most, and by size; each is sorted by one task. The driver holds their boundaries.
RANGES, MOST_RANGES, RANGE_BYTES = 192, 1 << 17, 128 << 20
#: Sampled keys by range, and in all, at most.
SAMPLE, MOST_SAMPLE = 32, 1 << 20
#: A range is overfull beyond this multiple of its fair share.
OVERFULL = 2.0
#: Share of a shard's bytes by which shards may differ so that equal texts stay together.
TOLERANCE = 0.01
#: A range may be subdivided this often.
ROUNDS = 3
_LEAST = -(1 << 63)


def text_key(text: Column) -> Column:
    """60 bits of the text's MD5, as a long."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def range_of(h: Column, i: Column, splitters: list[tuple[int, int]]) -> Column:
    """How many splitters (h, i) are at or below a key, by binary search over a constant array."""
    if not splitters:
        return F.lit(0)
    size = 1
    while size <= len(splitters):
        size *= 2
    top = [(1 << 63) - 1] * (size - 1 - len(splitters))
    hs, ids = long_array([*[a for a, _ in splitters], *top]), long_array([*[b for _, b in splitters], *top])
    steps = F.lit([size >> k for k in range(1, size.bit_length())])

    def above(at: Column) -> Column:
        x, y = F.get(hs, at - 1), F.get(ids, at - 1)
        return (h > x) | ((h == x) & (i >= y))

    return F.aggregate(steps, F.lit(0), lambda lo, step: F.when(above(lo + step), lo + step).otherwise(lo))


def _chosen(sample: list[tuple[int, int, float]], n: int) -> list[tuple[int, int]]:
    """At most n - 1 quantile boundaries. One inside a group of equal keys moves to its start unless the group spans several."""
    if not sample or n < 2:
        return []
    sample = sorted(sample)
    total = np.cumsum([w for *_, w in sample])
    picks = [sample[int(np.searchsorted(total, total[-1] * k / n))][:2] for k in range(1, n)]
    often = Counter(h for h, _ in picks)
    starts = {(h, _LEAST) for h, _ in picks}
    return sorted(starts | {p for p in picks if often[p[0]] > 1})


def _drawn(keys: DataFrame, probability: Column, salt: int) -> DataFrame:
    u = F.pmod(F.xxhash64(F.lit(salt), "h", "i"), F.lit(1 << 40)) / float(1 << 40)
    return keys.where(u < probability)


def splitters(keys: DataFrame, ranges: int = RANGES, sample: int = SAMPLE) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
    """(boundaries, [(range, bytes, rows)]) for `keys` (h, i, size)."""
    total, rows = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    if not rows:
        return [], []
    ranges = min(max(ranges, int(total // RANGE_BYTES)), max(ranges, MOST_RANGES))
    want = min(ranges * sample, max(MOST_SAMPLE, 4 * ranges))
    drawn = _drawn(keys, F.col("size") * (want / total), 1).select("h", "i", F.greatest(F.col("size").cast("double"), F.lit(total / want)).alias("w"))
    cuts = _chosen([tuple(r) for r in drawn.collect()], ranges)  # about `want` keys at most
    fair_b, fair_n = OVERFULL * total / ranges, OVERFULL * rows / ranges
    for attempt in range(ROUNDS + 1):
        held = keys.groupBy(range_of(F.col("h"), F.col("i"), cuts).alias("r")).agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()  # a row a range
        full = {x.r: (x.b, x.n) for x in held if x.b > fair_b or x.n > fair_n}
        if not full or attempt == ROUNDS:
            break
        # in an overfull range, draw by its own measure
        parts = {r: int(max(2 * b / fair_b, 2 * n / fair_n, 2)) for r, (b, n) in full.items()}
        by_bytes = {r: b / fair_b >= n / fair_n for r, (b, n) in full.items()}
        r = range_of(F.col("h"), F.col("i"), cuts)
        table = F.create_map(*[F.lit(x) for r_, p in parts.items() for x in (r_, p * sample / (full[r_][0] if by_bytes[r_] else full[r_][1]))])
        sized = F.create_map(*[F.lit(x) for r_ in parts for x in (r_, by_bytes[r_])])
        inside = keys.withColumn("r", r).where(F.col("r").isin(list(full)))
        rate = table[F.col("r")] * F.when(sized[F.col("r")], F.col("size")).otherwise(1)
        more = _drawn(inside, rate, 2 + attempt).select("r", "h", "i").collect()  # `sample` keys for each part
        new, own = set(cuts), defaultdict(list)
        for x in more:
            own[x.r].append((x.h, x.i, 1.0))
        for r_, found in own.items():
            new |= set(_chosen(found, parts[r_]))
        if len(new) == len(cuts):
            break
        cuts = sorted(new)
    return cuts, sorted((x.r, x.b, x.n) for x in held)


def shards(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", ranges: int = RANGES) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row; sizes by shard are equal but for a row or a small group."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    size = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long") + 1
    keys = docs.select(F.col(id_col).cast("long").alias("doc_id"), size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), text_key(text).alias("h"))
    keys = checkpointed(keys.withColumn("i", F.coalesce("doc_id", F.lit(_LEAST))))
    cuts, held = splitters(keys, ranges)
    total = sum(b for _, b, _ in held)
    if not held:
        return keys.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    # at most n_shards / TOLERANCE groups can be heavier than the tolerance
    heavy = [r.h for r in keys.groupBy("h").agg(F.sum("size").alias("b")).where(F.col("b") > TOLERANCE * total / n_shards).select("h").collect()]
    before_b = dict(zip([r for r, *_ in held], np.cumsum([0, *[b for _, b, _ in held]]).tolist()))
    before_n = dict(zip([r for r, *_ in held], np.cumsum([0, *[n for *_, n in held]]).tolist()))
    lookup = lambda d: F.get(long_array([int(d.get(r, 0)) for r in range(len(cuts) + 1)]), F.col("r"))
    ranged = keys.withColumn("r", range_of(F.col("h"), F.col("i"), cuts))
    inside = Window.partitionBy("r").orderBy("h", "i")
    same = Window.partitionBy("r", "h")
    placed = ranged.withColumns({"n": F.row_number().over(inside), "c": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))})
    alone = F.col("h").isin(heavy) if heavy else F.lit(False)
    # the middle of the row, or of the whole group, on the line of all bytes (doubled, to stay whole)
    middle = F.when(alone, 2 * F.col("c") - F.col("size")).otherwise(2 * F.min(F.col("c") - F.col("size")).over(same) + F.sum("size").over(same))
    line = middle + 2 * lookup(before_b)
    shard = F.least(F.floor(line * n_shards / F.lit(2 * total)), F.lit(n_shards - 1)).cast("int")
    placed = checkpointed(placed.select("doc_id", "size", "text_crc32", shard.alias("shard"), (lookup(before_n) + F.col("n") - 1).alias("at")))
    first = {r.shard: r.at for r in placed.groupBy("shard").agg(F.min("at").alias("at")).collect()}  # a row a shard
    start = F.get(long_array([int(first.get(s, 0)) for s in range(n_shards)]), F.col("shard"))
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("at") - start).cast("long").alias("slot"))
