"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

Each document's segmentation is drawn from the posterior over the whole piece lattice. The random
numbers are a hash of the row key and the byte position, so a row gets the same pieces whatever
partition, batch or retry it is in. The sampling thresholds are integers worked out chunk by chunk, so
neighbouring rows cannot change a draw either.

Defined cases: null text gives null ids and decodes to null; empty text gives an empty array; very long
texts are encoded whole; a null key counts as zero, a key that is no integer by the hash of its text; repeated rows get equal pieces; other columns are
carried along unchanged, except one of the name asked for the result, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .pieces import _FROM_LATTICE, STEP, Draws, Lattice, Table, Vocabulary, bytes_of, chunks, encoded, load_vocabulary, splitmix, to_lattice

SLICE = 2 << 20
#: Chunks whose lattices a worker keeps.
KEPT = 100_000
_tables: dict = {}


def table_of(vocabulary: Vocabulary) -> Table:
    """The table of a vocabulary, built once in a worker; kept by a digest of all pieces and scores."""
    key = vocabulary.digest
    if key not in _tables:
        _tables.clear()
        _tables[key] = Table(vocabulary)
    return _tables[key]


def sample(table: Table, texts: list[bytes], keys: np.ndarray, seed: int = 0, kept: Draws | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(piece ids of all texts in order, how many each text has).

    `kept` holds lattices of chunks met before; chunks met more than once here are added to it while it has room.
    """
    import pyarrow.compute as pc

    marked = [to_lattice(t) if t else b"" for t in texts]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    data = np.frombuffer(b"".join(marked), np.uint8)
    doc_starts = np.r_[0, np.cumsum(sizes)]
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    starts = chunks(data, doc_starts[:-1])
    which, words = encoded(data, np.r_[starts, len(data)])
    doc = np.searchsorted(doc_starts, starts, side="right") - 1
    with np.errstate(over="ignore"):
        key = splitmix(keys.astype(np.int64).view(np.uint64) ^ np.uint64(seed))[doc] + (starts - doc_starts[doc]).astype(np.uint64) * STEP
    kept = Draws() if kept is None else kept
    at = np.full(len(words), -1) if kept.words is None else np.array(pc.index_in(words, kept.words).fill_null(-1))
    fresh = at < 0
    often = fresh & (np.bincount(which, minlength=len(words)) > 1)
    out = np.zeros(len(data), np.int32)
    if often.any() and len(kept.end) + often.sum() <= KEPT:
        at[often] = len(kept.end) + np.arange(often.sum())
        part = words.filter(pa_mask(often))
        kept.add(part, Lattice(table, *bytes_of(part)))
        fresh &= ~often
    known = np.flatnonzero(~fresh[which])
    kept.draw(at[which[known]], starts[known], key[known], out)
    if fresh.any():
        part, rest = words.filter(pa_mask(fresh)), np.flatnonzero(fresh[which])
        once = Draws()
        once.add(part, Lattice(table, *bytes_of(part)))
        once.draw((np.cumsum(fresh) - 1)[which[rest]], starts[rest], key[rest], out)
    found = np.flatnonzero(out)
    return out[found] - 1, np.diff(np.searchsorted(found, doc_starts))


def pa_mask(mask: np.ndarray):
    import pyarrow as pa

    return pa.array(mask)


def row_keys(column) -> np.ndarray:
    """Integer keys as they are, null as zero; keys of any other type by a hash of their text."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import xxhash

    if pa.types.is_integer(column.type) or pa.types.is_null(column.type):
        return pc.fill_null(column.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
    return np.array([0 if k is None else xxhash.xxh64_intdigest(str(k)) for k in column.to_pylist()], np.uint64).view(np.int64)


def encode(docs: DataFrame, vocabulary: Vocabulary, key_col: str = "doc_id", text_col: str = "text", out_col: str = "ids", seed: int = 0) -> DataFrame:
    """`docs` with the sampled piece ids of `text_col`."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a vocabulary file's size
    docs = docs.drop(out_col)

    def run(batches) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        table, kept = table_of(shared.value), Draws()
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            keys = row_keys(batch.column(batch.schema.get_field_index(key_col)))
            for a, b in slices(sizes, SLICE):
                part = batch.slice(a, b - a)
                values = column.slice(a, b - a).cast(pa.binary()).to_pylist()
                ids, per_doc = sample(table, [v or b"" for v in values], keys[a:b], seed, kept)
                offsets = pa.array(np.r_[0, np.cumsum(per_doc)].astype(np.int32), mask=np.r_[[v is None for v in values], False])
                arrays = [*part.columns, pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))]
                yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, out_col])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{schema}, `{out_col}` array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """`encoded` with the text of `ids_col`: the pieces' bytes in hexadecimal, joined, without the space in front. Column expressions only."""
    # one literal of a vocabulary file's size, split once before the query runs
    pieces = F.split(F.lit(" ".join("" if p is None else p.translate(_FROM_LATTICE).hex() for p in vocabulary.pieces)), " ")
    whole = F.array_join(F.transform(ids_col, lambda i: F.get(pieces, i)), "")
    return encoded.withColumn(out_col, F.decode(F.unhex(F.substring(whole, F.lit(3), F.length(whole))), "UTF-8"))


def default_vocabulary() -> Vocabulary:
    import public_tokenizers

    return load_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
