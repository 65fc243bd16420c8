"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Text handled at once inside a Python worker, in bytes; bounds its memory whatever the batch size is.
SLICE_BYTES = 2 << 20


def shared_folder(spark: SparkSession) -> str:
    """The session's `spark.checkpoint.dir`. Where that is unset, a local session (tests) gets a folder of its own; a cluster is an error."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not folder:
            folder = tempfile.mkdtemp(prefix="checkpoints-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` computed once and kept in the shared checkpoint folder, so lost executors cost no recomputation. For narrow frames."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder as Parquet and read again: for wide frames, which a checkpoint would keep uncompressed."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.parquet(path)
    back.stored_at = path
    return back


def discarded(df: DataFrame) -> None:
    """Deletes what `stored` wrote for `df`, which is not read again; other frames are left alone."""
    if path := getattr(df, "stored_at", None):
        jvm = df.sparkSession.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


#: A key is hot with more than one in so many of all rows; so there are at most as many hot keys.
HOT = 1024


def joined_with_hot(rows: DataFrame, by_key: DataFrame, key: str) -> DataFrame:
    """`rows` joined with `by_key`, which has one row for each key and in `_rows` how many of `rows` have it.

    Rows of hot keys meet theirs by broadcast (HOT keys at most) and are not shuffled; the others are joined as usual.
    """
    by_key = checkpointed(by_key)
    total = by_key.agg(F.sum("_rows")).first()[0] or 0
    hot = by_key.where(F.col("_rows") > total / HOT).drop("_rows")
    rest = by_key.where(F.col("_rows") <= total / HOT).drop("_rows")
    met = rows.join(F.broadcast(hot), key)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key)
    return met.unionByName(others)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once, however often `body` mentions it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scanned(items: Column, start: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str, block: int = 128) -> Column:
    """Array of what `step(state, item)` gives for each item in order; it returns (next state, output of type `kind`).

    `F.aggregate` copies all it holds at every step, so outputs are not carried along: the states at the start of each
    block come first, and each block's outputs from its own. `start` is a small struct.
    """
    none = F.array().cast(f"array<{kind}>")

    def gathered(xs: Column) -> Column:
        # by places and not by slices: a slice copies the whole array first
        places = lambda b: F.sequence(b * block, F.least((b + 1) * block, F.size(xs)) - 1)
        blocks = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / block).cast("int"))

        def over(b: Column, state: Column) -> Column:
            return F.aggregate(places(b), state, lambda acc, i: step(acc, F.get(xs, i))[0])

        def opened(acc: Column, b: Column) -> Column:
            return F.struct(over(b, acc.state).alias("state"), F.concat(acc.starts, F.array(acc.state)).alias("starts"))

        def one(acc: Column, i: Column) -> Column:
            state, out = step(acc.state, F.get(xs, i))
            return F.struct(state.alias("state"), F.concat(acc.out, F.array(out)).alias("out"))

        def closed(starts: Column) -> Column:
            return F.flatten(F.transform(blocks, lambda b: F.aggregate(places(b), F.struct(F.get(starts, b).alias("state"), none.alias("out")), one, lambda acc: acc.out)))

        starts = F.aggregate(blocks, F.struct(start.alias("state"), F.filter(F.array(start), lambda _: F.lit(False)).alias("starts")), opened, lambda acc: acc.starts)
        return F.when(F.size(xs) > 0, let(starts, closed)).otherwise(none)

    return let(items, gathered)


def first_at(size: Column, above: Callable[[Column], Column]) -> Column:
    """The least i in 0..size with above(i), or size; `above` is monotone. Binary search."""
    halves = F.sequence(F.lit(0), F.greatest(F.ceil(F.log2(size + 1)).cast("int"), F.lit(0)))
    start = F.struct(F.lit(0).alias("low"), size.alias("high"))

    def step(acc: Column, _: Column) -> Column:
        middle = F.shiftright(acc.low + acc.high, 1)
        narrowed = F.when(above(middle), F.struct(acc.low.alias("low"), middle.alias("high"))).otherwise(F.struct((middle + 1).alias("low"), acc.high.alias("high")))
        return F.when(acc.low < acc.high, narrowed).otherwise(acc)

    return F.aggregate(halves, start, step).low


def long_array(values: list[int]) -> Column:
    """A constant array of longs, as one literal however many there are (folded before the query runs)."""
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(" ".join(map(str, values))), " ").cast("array<bigint>")


def text_of(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh(name: str, columns: list[str]) -> str:
    """`name`, with underscores added until no column has it."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def packed(docs: DataFrame, keep: list[str]) -> Column:
    """The columns `keep` as one struct `_row`, so that no name of theirs meets a name used here; `_row.*` gives them back."""
    return F.struct(*[docs[f"`{c}`"].alias(c) for c in keep]).alias("_row")


def bucket_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal digits, modulo `modulus`; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, modulus: int, held: int, most: int, columns: list[str]) -> DataFrame:
    """At most about `most` labelled rows outside the held-out remainder, drawn by a hash of doc_id.

    `labels` is narrow; it is cut down to the sample first, so the wide side of the join loses nearly
    all its rows before anything is shuffled. The bound holds for any input size. Rows with a null id or
    a null label teach nothing; of repeated label rows the larger label counts.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull()).where(bucket_of(F.col("doc_id"), modulus) != held)
    known = known.groupBy("doc_id").agg(F.max(target).cast("int").alias("_y"))
    n = known.count()
    if n > most:
        known = known.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20)) < int((1 << 20) * most / n))
    # at most `most` pairs of id and label: small enough to send everywhere
    return docs.select("doc_id", *[c for c in columns if c != "doc_id"]).join(F.broadcast(known), "doc_id")


def slices(sizes: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows with about `limit` bytes each (one row at least)."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += int(size)
    if start < len(sizes):
        yield start, len(sizes)


def texts_of(array) -> list[bytes]:
    """UTF-8 bytes of an Arrow string array, null as empty."""
    import pyarrow as pa

    return [b if b is not None else b"" for b in array.cast(pa.binary()).to_pylist()]


def text_slices(batch, name: str = "text") -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, last row exclusive, texts) over an Arrow record batch."""
    import pyarrow.compute as pc

    column = batch.column(batch.schema.get_field_index(name))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for a, b in slices(sizes):
        yield a, b, texts_of(column.slice(a, b - a))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
