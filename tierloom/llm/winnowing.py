"""Document fingerprints by winnowing.

Tokens are runs of characters that are not white space, in lower case. A character of a script without spaces between
words (Han, Kana, Thai, Lao, Khmer, Myanmar) is a token of its own, and so is each character of a run of more than
`RUN`, so tokens never depend on how far a run has gone before. Every `GRAM` consecutive tokens give a rolling hash
(their hashes rotated and xored: the last one rotated on, the new token in, the oldest out), every window of `WINDOW`
consecutive hashes gives up its minimum, of equal ones the rightmost, and each chosen gram is kept once, with the
code point at which its first token begins. Any passage that is `GRAM + WINDOW - 1` tokens of both texts is therefore
met by an equal hash in both fingerprints, and the positions say where.

All of it is column expressions over the whole text, linear in its length. A hash has 32 bits and a
position 31, packed into one long so that a window's minimum with its tie rule is a plain minimum.

Defined cases: null text is empty; an empty or blank text has an empty fingerprint, and two empty ones have
likeness 1; a text with fewer than `GRAM` tokens has one gram, all its tokens, and one with fewer than
`WINDOW` grams is one window; very long texts are fingerprinted whole; other columns are ignored, whatever they are called.

`ranged` lets each document meet its next one, in ascending order of doc_id and, of equal ids, of the text's hash,
without gathering rows: ranges of keys from sampled splitters, a window inside each range, and the first row of every
range copied to the one before. A null doc_id sorts first; repeated rows follow each other; an empty table gives none.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, let, long_array, text_of
from .sharding import _LEAST, range_of, splitters

GRAM = 3
WINDOW = 4
RUN = 24
#: Tokens whose grams are rolled in one go.
BLOCK = 16
_LAST = (1 << 31) - 1


_WHITE = " \t\n\x0b\f\r"  # what \s stands for
_ALONE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"


def tokens(text: Column) -> Column:
    """Array of the tokens of a text that is not null and begins with none, each with the white space behind it."""
    words = r"(?<=\s)(?=\S)"
    parts = F.when(text.rlike(f"[{_ALONE}]"), F.split(text, rf"{words}|(?<=[{_ALONE}])(?=\S)|(?<=\S)(?=[{_ALONE}])", -1)).otherwise(F.split(text, words, -1))
    run = rf"\S{{{RUN + 1}}}"
    single = lambda p: F.when(p.rlike(run), F.split(p, r"(?<=\S)(?=\S)", -1)).otherwise(F.array(p))
    return F.when(text == "", F.array().cast("array<string>")).when(text.rlike(run), F.flatten(F.transform(parts, single))).otherwise(parts)


def _rotated(h: Column, by: int) -> Column:
    by %= 64
    return F.shiftleft(h, by).bitwiseOR(F.shiftrightunsigned(h, 64 - by)) if by else h


def rolled(text: Column, offset: Column, gram: int = GRAM) -> Column:
    """The gram that ends with each token, as hash * 2**31 + (2**31 - 1 - position); the first gram - 1 have fewer tokens. `offset` is where the text begins."""
    def grams(parts: Column, hashes: Column, lead: Column) -> Column:
        """(hash, position) of the gram that ends with each token, rolled along in blocks that each begin with the tokens before them."""
        n, size = F.size(hashes), F.lit(BLOCK)
        long = lambda i: F.length(F.get(parts, i))
        last = F.floor((n - 1) / size).cast("int")
        within = lambda b: F.sequence(b * size, F.least((b + 1) * size, n) - 1)

        def summed(acc: Column, some: Column) -> Column:
            """`acc`, prefix sums of lengths, with one more: that of the tokens at `some`."""
            return F.concat(acc, F.array(F.element_at(acc, -1) + F.aggregate(some, F.lit(0), lambda at, i: at + long(i))))

        # where blocks begin: first by BLOCK blocks, then inside each of these; what an aggregate holds is copied at every step
        groups = F.sequence(F.lit(0), F.floor(last / size).cast("int"))
        wide = F.aggregate(groups, F.array(lead), lambda acc, g: summed(acc, F.sequence(g * size * size, F.least((g + 1) * size * size, n) - 1)))
        inner = lambda at, g: F.aggregate(F.sequence(g * size, F.least((g + 1) * size, last + 1) - 1), F.array(F.get(at, g)), lambda acc, b: summed(acc, within(b)), lambda acc: F.slice(acc, 1, F.size(acc) - 1))
        offsets = let(wide, lambda at: F.flatten(F.transform(groups, lambda g: inner(at, g))))

        def step(acc: Column, i: Column) -> Column:
            old = F.when(i >= gram, _rotated(F.get(hashes, i - gram), gram)).otherwise(F.lit(0))
            roll = _rotated(acc.roll, 1).bitwiseXOR(F.get(hashes, i)).bitwiseXOR(old)
            packed = F.shiftleft(F.shiftrightunsigned(roll, 32), 31).bitwiseOR((_LAST - acc.at).cast("long"))
            gone = F.when(i >= gram - 1, long(i - gram + 1)).otherwise(F.lit(0))
            return F.struct((acc.at + gone).alias("at"), roll.alias("roll"), F.concat(acc.out, F.array(packed)).alias("out"))

        def block(b: Column, offset: Column) -> Column:
            i = b * size
            # the first token of the gram that ends at i, and the hash of the gram before
            back = reduce(add, [F.when(i >= k, long(i - k)).otherwise(F.lit(0)) for k in range(1, gram)])
            roll = reduce(Column.bitwiseXOR, [F.when(i > k, _rotated(F.get(hashes, i - 1 - k), k)).otherwise(F.lit(0).cast("long")) for k in range(gram)])
            start = F.struct((offset - back).alias("at"), roll.alias("roll"), F.array().cast("array<bigint>").alias("out"))
            return F.aggregate(within(b), start, step, lambda acc: acc.out)

        return let(offsets, lambda at: F.flatten(F.transform(F.sequence(F.lit(0), last), lambda b: block(b, F.get(at, b)))))

    body = F.ltrim(text, F.lit(_WHITE))
    lead = offset + F.length(text) - F.length(body)
    hashes = lambda parts: F.transform(parts, lambda p: F.xxhash64(F.lower(F.rtrim(p, F.lit(_WHITE)))))
    return let(tokens(body), lambda parts: F.when(F.size(parts) == 0, F.array().cast("array<bigint>")).otherwise(let(hashes(parts), lambda h: grams(parts, h, lead))))


def _whole(g: Column, gram: int) -> Column:
    """Without what ends before the first whole gram; of a text that has none, all its tokens are one."""
    return F.when(F.size(g) < gram, F.slice(g, -1, 1)).otherwise(F.slice(g, gram, F.size(g)))


def _minima(g: Column, window: int) -> Column:
    """The least gram of each window, once each."""
    many = F.transform(F.sequence(F.lit(0), F.size(g) - window), lambda i: F.least(*[F.get(g, i + k) for k in range(window)]))
    least = F.array_distinct(F.when(F.size(g) < window, F.array(F.array_min(g))).otherwise(many))
    return F.when(F.size(g) == 0, F.array().cast("array<bigint>")).otherwise(least)


def winnowed(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """Array of chosen (hash, position) pairs, packed as hash * 2**31 + (2**31 - 1 - position), by position."""
    grams = let(rolled(text, F.lit(0), gram), lambda g: F.when(F.size(g) == 0, g).otherwise(_whole(g, gram)))
    return let(grams, lambda g: _minima(g, window))


def winnowed_with_edit(text: Column, cut: Column, edited: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """Struct of the fingerprints `own` and `edited` of a text and another that has the same first `cut` code points, whose grams are rolled once.

    Runs without white space that end before the cut have the same tokens in both; grams that begin `gram` - 1 runs before the last
    of these, or earlier, lie in them. From there on the edited text is rolled anew.
    """
    back = F.length(F.regexp_extract(F.reverse(F.left(text, cut)), rf"^(\S*+(?:\s++\S++){{0,{gram - 1}}}+)", 1))

    def both(g: Column, at: Column) -> Column:
        kept = F.filter(g, lambda x: (_LAST - x.bitwiseAND(F.lit(_LAST))) < at)
        at_start = F.size(kept) == 0
        # the first gram - 1 of them end before any whole gram; none is kept of a text that has no run before
        first = F.slice(kept, gram, F.greatest(F.size(kept), F.lit(1)))
        more = let(rolled(F.substring(edited, at + 1, F.length(edited)), at, gram), lambda t: F.when(at_start, F.when(F.size(t) == 0, t).otherwise(_whole(t, gram))).otherwise(F.slice(t, gram, F.greatest(F.size(t), F.lit(1)))))
        own = let(F.when(F.size(g) == 0, g).otherwise(_whole(g, gram)), lambda x: _minima(x, window))
        return F.struct(own.alias("own"), let(F.concat(first, more), lambda x: _minima(x, window)).alias("edited"))

    return let(rolled(text, F.lit(0), gram), lambda g: let(F.greatest(cut - back, F.lit(0)), lambda at: both(g, at)))


def hashes_of(chosen: Column) -> Column:
    """The distinct hashes of a fingerprint, without positions."""
    return F.array_distinct(F.transform(chosen, lambda x: F.shiftrightunsigned(x, 31)))


def written(chosen: Column) -> Column:
    """The fingerprint as text: `hash@position` in hexadecimal and decimal, by position, comma-joined."""
    return F.array_join(F.transform(chosen, lambda x: F.concat(F.lower(F.hex(F.shiftrightunsigned(x, 31))), F.lit("@"), (_LAST - x.bitwiseAND(F.lit(_LAST))).cast("string"))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two arrays of distinct hashes; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    return let(both, lambda n: F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(n / (F.size(a) + F.size(b) - n)))


def ranged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, _text, _r, _i, _h, _ghost): rows with their range; the first of each range also, as a ghost, in the range before (cyclically)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("_text"))
    rows = rows.withColumns({"_i": F.coalesce("doc_id", F.lit(_LEAST)), "_h": F.xxhash64("_text")})
    keys = checkpointed(rows.select(F.col("_i").alias("h"), F.col("_h").alias("i"), (F.octet_length("_text") + 1).cast("long").alias("size")))
    cuts, held = splitters(keys)
    r = range_of(F.col("_i"), F.col("_h"), cuts)
    firsts = keys.groupBy(range_of(F.col("h"), F.col("i"), cuts).alias("r")).agg(F.min(F.struct("h", "i")).alias("k")).orderBy("r").collect()  # a row a range
    to = [x.r for x in firsts]
    before = {(x.k.h, x.k.i): to[k - 1] for k, x in enumerate(firsts)}
    own = rows.withColumn("_r", r)
    if not firsts:
        return own.withColumn("_ghost", F.lit(False))
    # a range's first key, if this row has it: where the copy goes
    table = {x.r: x.k for x in firsts}
    size = len(cuts) + 1
    first_h, first_i = long_array([table[k].h if k in table else 0 for k in range(size)]), long_array([table[k].i if k in table else 0 for k in range(size)])
    target = long_array([before[table[k].h, table[k].i] if k in table else -1 for k in range(size)]).cast("array<int>")
    is_first = (F.col("_i") == F.get(first_h, F.col("_r"))) & (F.col("_h") == F.get(first_i, F.col("_r")))
    copies = F.when(is_first, F.array(F.struct(F.col("_r").alias("r"), F.lit(False).alias("g")), F.struct(F.get(target, F.col("_r")).alias("r"), F.lit(True).alias("g")))).otherwise(F.array(F.struct(F.col("_r").alias("r"), F.lit(False).alias("g"))))
    spread = own.withColumn("_x", F.explode(copies))
    return spread.select("doc_id", "_text", "_i", "_h", F.col("_x.r").alias("_r"), F.col("_x.g").alias("_ghost"))


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's fingerprint beside that of its edited text and its next document's.

    The edited text has its last floor(n / 2) code points replaced by the first as many (or all) of the next.
    """
    order = Window.partitionBy("_r").orderBy("_ghost", "_i", "_h")
    rows = ranged(docs, id_col, text_col).withColumn("_next", F.lead("_text").over(order))
    size = F.length("_text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.substring("_text", F.lit(1), size - half), F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half))
    rows = rows.select("doc_id", "_r", "_i", "_h", "_ghost", "_text", edited.alias("_edited"))
    rows = rows.withColumn("_both", winnowed_with_edit(F.col("_text"), size - half, F.col("_edited")))
    rows = rows.select("doc_id", "_r", "_i", "_h", "_ghost", size.cast("long").alias("n_chars"), F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"), F.col("_both.own").alias("_fp"), F.col("_both.edited").alias("_fp_edited"))
    rows = rows.withColumn("_fp_next", F.lead("_fp").over(order)).where("not _ghost")
    sets = rows.withColumns({"_a": hashes_of(F.col("_fp")), "_b": hashes_of(F.col("_fp_edited")), "_c": hashes_of(F.col("_fp_next"))})
    return sets.select(
        "doc_id", "n_chars", "edited_sha256", written(F.col("_fp")).alias("fingerprint"), written(F.col("_fp_edited")).alias("edited_fingerprint"),
        likeness(F.col("_a"), F.col("_b")).alias("near_edited"), likeness(F.col("_a"), F.col("_c")).alias("near_next"),
    )
