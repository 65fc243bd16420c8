"""SimHash near-duplicate detection with pivot distance tables.

Every text gets a 64-bit SimHash over its three-word shingles. Two fingerprints that differ in at most
three bits are linked; a component is what links reach. Equal fingerprints are merged before any
comparison, so a group of copies is one node however many rows it has.

Which fingerprints meet: 64 bits fall into six groups. Three differing bits touch three groups at
most, so a linked pair agrees on three whole groups at least; each fingerprint goes to its 20 triples of
groups, a cell being the bits of one triple. A cell with more than `CELL` members is dealt out anew in the same way
by its free bits, at most twice more; then nine bits are free and 512 members are all there can be. So no
task compares more than the pairs of a cell, whatever boilerplate the corpus holds, and no link is lost.
Inside a cell, members are ordered by their distance to one reference fingerprint and meet only within three of
it; a table of distances to further references discards every pair with a coordinate difference above three (the
triangle inequality), and survivors are verified bit by bit. Only links are written, as a forest of each cell.

Defined cases: null or blank text has fingerprint zero and links like any other; a text of one or two
words has one shingle; repeated rows are each returned; a null doc_id is returned but never becomes
the component's id unless the component has no other (then null); other columns are ignored, or carried along on request.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, joined_with_hot, text_slices

SEED = 42
SHINGLE = 3
MAX_BITS = 3
#: Bit groups (lowest bit, width) by how many bits are free: of a whole fingerprint, of a cell's rest, of that one's rest.
GROUPS = {64: ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)), 33: ((0, 6), (6, 6), (12, 6), (18, 5), (23, 5), (28, 5)), 18: ((0, 3), (3, 3), (6, 3), (9, 3), (12, 3), (15, 3))}
#: Members of a cell; one with more is dealt out anew.
CELL = 2048
#: Reference fingerprints of the distance table, drawn once from a fixed generator.
PIVOTS = np.random.default_rng(7).integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def fingerprint(text: bytes) -> int:
    """Unsigned 64-bit SimHash of UTF-8 bytes."""
    import xxhash

    words = text.lower().split()  # for bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - SHINGLE + 1)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: n - 1]]
    ends = ends[-n:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for a in range(0, n, 1 << 16):
        b = min(n, a + (1 << 16))
        h = np.fromiter((digest(joined[s : e - 1], SEED) for s, e in zip(starts[a:b], ends[a:b])), np.uint64, b - a)
        counts += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] = ()) -> DataFrame:
    """(doc_id, fp, *carry): the fingerprint as a signed long. A carried column must not have one of these names."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *[F.col(f"`{c}`") for c in carry], F.col(text_col).cast("string").alias("_simhash_text"))

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            for a, b, texts in text_slices(batch, "_simhash_text"):
                out[a:b] = [fingerprint(t) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64)), *batch.columns[1:-1]], ["doc_id", "fp", *carry])

    return rows.mapInArrow(run, "doc_id long, fp long" + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:-1]))


def _bits(x: Column, groups: list[tuple[int, int]]) -> Column:
    """The bits of some groups, put together."""
    key = F.lit(0).cast("long")
    for at, width in groups:
        key = F.shiftleft(key, width).bitwiseOR(F.shiftrightunsigned(x, at).bitwiseAND(F.lit((1 << width) - 1)))
    return key


def dealt(rows: DataFrame, free: int) -> DataFrame:
    """(fp, cell, rest): each row of (fp, cell, rest) in 20 cells, by three of the groups of its `free` rest bits; the others are the new rest.

    A cell is named by a hash; should two have the same, they are compared together, and pairs are verified anyway.
    """
    groups, cells = GROUPS[free], []
    for k, some in enumerate(itertools.combinations(range(6), 3)):
        held, left = [groups[g] for g in some], [groups[g] for g in range(6) if g not in some]
        cells.append(F.struct(F.xxhash64("cell", F.lit(k), _bits(F.col("rest"), held)).alias("cell"), _bits(F.col("rest"), left).alias("rest")))
    return rows.select("fp", F.explode(F.array(*cells)).alias("x")).select("fp", "x.cell", "x.rest")


def linked(fp: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with the same key and at most MAX_BITS differing bits. `key` is ascending.

    Small keys are compared by lag across all keys at once; large ones in strips against a window of the
    first pivot's distance. Pairs that the other pivots leave are verified.
    """
    table = np.bitwise_count(fp[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    order = np.lexsort((table[:, 0], key))
    fp, key, table = fp[order], key[order], table[order]
    first = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
    group = np.cumsum(first) - 1
    sizes = np.bincount(group) if len(key) else np.zeros(0, int)
    left, right = [], []

    def keep(i: np.ndarray, j: np.ndarray) -> None:
        for p in range(table.shape[1]):
            near = np.abs(table[i, p] - table[j, p]) <= MAX_BITS
            i, j = i[near], j[near]
        ok = np.bitwise_count(fp[i] ^ fp[j]) <= MAX_BITS
        left.append(order[i[ok]])
        right.append(order[j[ok]])

    small = sizes[group] <= 64 if len(key) else np.zeros(0, bool)
    at = np.flatnonzero(small)
    for lag in range(1, int(sizes[sizes <= 64].max(initial=1))):
        i = at[at + lag < len(fp)]
        i = i[group[i] == group[i + lag]]
        if not len(i):
            break
        keep(i, i + lag)
    starts = np.flatnonzero(first)
    for g in np.flatnonzero(sizes > 64):
        a, b = starts[g], starts[g] + sizes[g]
        d = table[a:b, 0]
        reach = np.searchsorted(d, d + MAX_BITS, side="right")
        for s in range(0, b - a, 128):
            e = min(b - a, s + 128)
            i, j = np.meshgrid(np.arange(s, e), np.arange(s, reach[e - 1]), indexing="ij")
            near = (j > i) & (j < reach[i])
            keep(a + i[near], a + j[near])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, int), np.zeros(0, int))


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the least node that the pairs reach."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return label


def _links(batches) -> Iterator:
    """(u, v) from rows (cell, fp) that come sorted by cell: the links of each cell as a forest, v being the least that u reaches."""
    import pandas as pd

    rest = None

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        fp = rows["fp"].to_numpy().view(np.uint64)
        a, b = linked(fp, rows["cell"].to_numpy())
        root = forest(a, b, len(fp))
        moved = np.flatnonzero(root != np.arange(len(fp)))
        return pd.DataFrame({"u": fp[moved].view(np.int64), "v": fp[root[moved]].view(np.int64)}).drop_duplicates()

    for rows in batches:
        if rest is not None:
            rows = pd.concat([rest, rows], ignore_index=True)
        if not len(rows):
            continue
        whole = rows["cell"].to_numpy() != rows["cell"].iloc[-1]
        cut = int(whole.nonzero()[0][-1]) + 1 if whole.any() else 0
        rest = rows.iloc[cut:].reset_index(drop=True)
        if cut:
            yield links(rows.iloc[:cut].reset_index(drop=True))
    if rest is not None and len(rest):
        yield links(rest)


def link_forest(fps: DataFrame) -> DataFrame:
    """(u, v): links between distinct fingerprints `fp`, as many as join them and no more than one for each node and cell."""
    level, found = fps.select("fp", F.lit(0).cast("long").alias("cell"), F.col("fp").alias("rest")), []
    for free in GROUPS:
        cells = dealt(level, free)
        met = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
        members = cells.join(met, "cell")
        last = free == min(GROUPS)
        small = members if last else members.where(F.col("n") <= CELL)
        found.append(small.select("cell", "fp").repartition("cell").sortWithinPartitions("cell").mapInPandas(_links, "u long, v long"))
        if last or met.where(F.col("n") > CELL).isEmpty():
            break
        level = checkpointed(members.where(F.col("n") > CELL).select("fp", "cell", "rest"))
    return reduce(DataFrame.union, found).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that an edge (u, v) touches, by alternating large and small stars."""
    edges = checkpointed(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        new = checkpointed(small)
        # done when no node is both above and below an edge and none has two parents
        up = new.groupBy("u").agg(F.count("*").alias("n"))
        open_ = up.where("n > 1").select("u").union(new.select(F.col("v").alias("u")).join(up.select("u"), "u", "left_semi")).limit(1)
        edges = new
        if open_.isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] = ()) -> DataFrame:
    """(doc_id, fp, component_id, component, *carry): one row per document; component_id is the least doc_id that links reach, component a fingerprint of it, never null."""
    marked = checkpointed(fingerprints(docs, id_col, text_col, carry))
    nodes = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")))
    roots = components(link_forest(nodes.select("fp")))
    rooted = checkpointed(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("root", "fp")).drop("root"))
    least = rooted.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("_rows"))
    named = joined_with_hot(rooted.select("fp", "component", F.col("copies").alias("_rows")), least, "component")
    return joined_with_hot(marked, named, "fp").select("doc_id", "fp", "component_id", "component", *carry)


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
