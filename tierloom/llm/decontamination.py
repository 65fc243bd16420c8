"""Benchmark decontamination by a prefix-filtered containment join.

Every benchmark item gives its windows of consecutive words (the whole item if it is shorter). A window must
be contained whole, so of its words ordered by rarity over all documents the first alone is the necessary
prefix: a document without a window's rarest word cannot hold the window. Document positions of such words
meet the windows filed under them; the word's place in the window fixes where the window would begin
(positional bound), which must lie inside the document (length bound); survivors are verified word by word.

Windows are held in blocks of `WINDOWS`. The driver and the workers hold one block at a time: it is filed, sent out, met
with all documents and taken back before the next. Long items are cut into pieces that share `WORDS` - 1 words, so
that no item makes a block large. With one block the result is one pass over the documents; with several, each
leaves the hit positions of the texts it meets, by a digest of the text, and these few rows are joined in the end.

Defined cases: null or wordless text has no words and no hits; an item without words (or null) has no window;
repeated items count once per distinct item_id, a null item_id is ignored; ids are compared and returned as strings;
repeated documents are each returned; without items nothing is hit; columns asked for in `carry` come along unchanged,
others are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, fresh, slices, text_slices, texts_of
from .pieces import distinct

WORDS = 10
#: Windows of a block.
WINDOWS = 200_000
#: Lower-cases A-Z and turns everything that is no word byte into a space; bytes above 0x7F belong to words.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def word_ids(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, object]:
    """(index of each word among the distinct words, where each text's words start, the distinct words)."""
    import pyarrow as pa

    data = np.frombuffer((b" ".join(texts) + b" ").translate(_FOLD), np.uint8)
    space = data == 0x20
    before = np.r_[True, space[:-1]]
    start, end = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    first = np.r_[0, np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))]
    which, body, at = distinct(data[~space], np.r_[0, np.cumsum(end - start)])
    return which, first, pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(body))])


class Block:
    """Windows of some pieces (item, words). `order` files them by the rarity of their words; before that there is no index."""

    def __init__(self, pieces: list[tuple[str, bytes]], size: int):
        texts = [(i, words.split()) for i, words in pieces]
        self.vocabulary = sorted({w for _, words in texts for w in words})
        number = {w: k for k, w in enumerate(self.vocabulary)}
        windows: dict[tuple, set] = {}
        for item, words in texts:
            ids = [number[w] for w in words]
            for a in range(max(1, len(ids) - size + 1) if ids else 0):
                windows.setdefault(tuple(ids[a : a + size]), set()).add(item)
        self.windows = sorted(windows)
        self.items = [sorted(windows[w]) for w in self.windows]
        self.size = size

    def order(self, uses: np.ndarray) -> Block:
        """Files each window under its rarest word."""
        self.length = np.array([len(w) for w in self.windows], np.int64)
        self.ids = np.full((len(self.windows), self.size), -1, np.int32)
        prefix, place = np.zeros(len(self.windows), np.int64), np.zeros(len(self.windows), np.int64)
        for k, w in enumerate(self.windows):
            self.ids[k, : len(w)] = w
            place[k] = min(range(len(w)), key=lambda j: (uses[w[j]], w[j], j))
            prefix[k] = w[place[k]]
        self.filed = np.argsort(prefix, kind="stable")
        self.first = np.r_[0, np.searchsorted(prefix[self.filed], np.arange(1, len(self.vocabulary) + 1))]
        self.place = place
        return self

    def occurrences(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, window) of every occurrence in the texts whose words start at `first` in `ids`."""
        at = np.flatnonzero(ids >= 0)
        many = np.diff(self.first)[ids[at]]
        at, many = at[many > 0], many[many > 0]
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for a, b in slices(many, 1 << 20):  # candidates held at once
            n = many[a:b]
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            p = np.repeat(at[a:b], n)
            w = self.filed[self.first[ids[p]] + nth]
            text = np.searchsorted(first, p, side="right") - 1
            p = p - self.place[w]
            ok = (p >= first[text]) & (p + self.length[w] <= first[text + 1])
            p, w = p[ok], w[ok]
            for j in range(self.size):
                same = (self.length[w] <= j) | (ids[np.minimum(p + j, len(ids) - 1)] == self.ids[w, j])
                p, w = p[same], w[same]
            out.append((p, w))
        return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def _pieces(benchmark: DataFrame, size: int, windows: int) -> DataFrame:
    """(item, words, windows): the folded words of items, in pieces of at most `windows` windows."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out: list[tuple] = []
            for item, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                words = text.translate(_FOLD).split()
                for a in range(0, max(1, len(words) - size + 1) if words else 0, windows):
                    own = words[a : a + windows + size - 1]
                    out.append((item, b" ".join(own), max(1, len(own) - size + 1)))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.string(), pa.binary(), pa.int64()))], ["item", "words", "windows"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")).where("item is not null")
    return items.mapInArrow(run, "item string, words binary, windows long").distinct()


def _blocks(benchmark: DataFrame, size: int, windows: int) -> Iterator[Block]:
    """Blocks of about `windows` windows, one at a time; at least one."""
    pieces = _pieces(benchmark, size, windows)
    n = max(1, math.ceil(int(pieces.agg(F.sum("windows")).first()[0] or 0) / windows))
    pieces = checkpointed(pieces) if n > 1 else pieces
    for b in range(n):
        part = pieces.where(F.pmod(F.xxhash64("item", "words"), F.lit(n)) == b) if n > 1 else pieces
        yield Block([(i, bytes(w)) for i, w in part.select("item", "words").collect()], size)  # a block's windows


def _uses(docs: DataFrame, body: str, block: Block) -> np.ndarray:
    """How often each of a block's words occurs over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(block.vocabulary)

    def run(batches) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        known, total = pa.array(shared.value, pa.binary()), np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for _, _, texts in text_slices(batch, body):
                which, _, words = word_ids(texts)
                at = pc.index_in(words, known).fill_null(-1).to_numpy(zero_copy_only=False)
                np.add.at(total, at[at >= 0], np.bincount(which, minlength=len(words))[at >= 0])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["word", "n"])

    uses = np.zeros(len(block.vocabulary), np.int64)
    for w, n in docs.select(body).mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n")).collect():  # a block's words
        uses[w] = n
    shared.destroy()
    return uses


def _met(block: Block, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[set]]:
    """(where texts begin among all words, whether each word is hit, ids of items met by each text)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    which, first, words = word_ids(texts)
    edge = np.zeros(len(which) + 1, np.int64)
    found: list[set] = [set() for _ in texts]
    if len(which):
        number = pc.index_in(words, pa.array(block.vocabulary, pa.binary())).fill_null(-1).to_numpy(zero_copy_only=False)
        p, w = block.occurrences(number[which], first)
        np.add.at(edge, p, 1)
        np.add.at(edge, p + block.length[w], -1)
        text = np.searchsorted(first, p, side="right") - 1
        for t, k in np.unique(np.c_[text, w], axis=0).tolist() if len(p) else ():
            found[t].update(block.items[k])
    return first, np.cumsum(edge[:-1]) > 0, found


def _partly(docs: DataFrame, body: str, block: Block) -> DataFrame:
    """(text_key, hit, items): of the distinct texts that a block meets, the positions of hit words and the items."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches) -> Iterator:
        import pyarrow as pa

        block = shared.value
        for batch in batches:
            for a, _, texts in text_slices(batch, body):
                first, hit, found = _met(block, texts)
                some = [t for t, x in enumerate(found) if x]
                at = [np.flatnonzero(hit[first[t] : first[t + 1]]) for t in some]
                keys = batch.column(batch.num_columns - 1).take(pa.array([a + t for t in some], pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, pa.array(at, pa.list_(pa.int32())), pa.array([sorted(found[t]) for t in some], pa.list_(pa.string()))], ["text_key", "hit", "items"])

    rows = docs.select(body, _text_key(body).alias("_key")).mapInArrow(run, "text_key string, hit array<int>, items array<string>")
    kept = checkpointed(rows.dropDuplicates(["text_key"]))
    shared.destroy()
    return kept


def _text_key(body: str):
    return F.md5(F.coalesce(F.col(body), F.lit("")).cast("binary"))


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WORDS, windows: int = WINDOWS, carry: list[str] = ("doc_id",), text_col: str = "text", names: tuple[str, str, str] = ("n_words", "n_hit", "items")) -> DataFrame:
    """`carry` columns of every document and, under `names`, its words, hit words and the ids of items with occurring windows.

    A carried column of one of these names gives way.
    """
    sc = docs.sparkSession.sparkContext
    carry = [c for c in carry if c not in names]
    docs = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(text_col).cast("string").alias(body := fresh("_body", carry)))
    blocks = _blocks(benchmark, size, windows)
    block, parts = next(blocks), []
    block.order(_uses(docs, body, block))
    for more in blocks:
        parts = parts or [_partly(docs, body, block)]
        block = None
        parts.append(_partly(docs, body, more.order(_uses(docs, body, more))))
    shared = sc.broadcast(block)  # one block, or none where all have been met already

    def run(batches) -> Iterator:
        import pyarrow as pa

        block = shared.value
        for batch in batches:
            for a, b, texts in text_slices(batch, body):
                if block is None:
                    _, first, _ = word_ids(texts)
                    n_hit, found = np.zeros(b - a, np.int64), [None] * (b - a)
                else:
                    first, hit, found = _met(block, texts)
                    n_hit = np.diff(np.r_[0, np.cumsum(hit)][first])
                arrays = [*[batch.column(i).slice(a, b - a) for i in range(len(carry))], pa.array(np.diff(first).astype(np.int64)), pa.array(n_hit.astype(np.int64)), pa.array([x and sorted(x) or [] for x in found], pa.list_(pa.string()))]
                extra = [] if block is not None else [batch.column(batch.num_columns - 1).slice(a, b - a)]
                yield pa.RecordBatch.from_arrays([*arrays, *extra], [*carry, *names, *([key] if extra else [])])

    key = fresh("_text_key", [*carry, *names])
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields[:-1]) + "`{}` long, `{}` long, `{}` array<string>".format(*names)
    if not parts:
        return docs.mapInArrow(run, schema)
    union = reduce(DataFrame.union, parts).groupBy("text_key").agg(F.size(F.array_distinct(F.flatten(F.collect_list("hit")))).cast("long").alias("_hit"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("_items"))
    met = checkpointed(union).select(F.col("text_key").alias(key), F.struct("_hit", "_items").alias(more := fresh("_more", [*carry, *names, key])))
    rows = docs.withColumn(key, _text_key(body)).mapInArrow(run, f"{schema}, `{key}` string").join(met, key, "left")
    return rows.select(*[F.col(f"`{c}`") for c in carry], names[0], F.coalesce(F.col(f"{more}._hit"), F.lit(0)).cast("long").alias(names[1]), F.coalesce(F.col(f"{more}._items"), F.array().cast("array<string>")).alias(names[2]))
