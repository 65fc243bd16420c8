"""Text functions: normalisation, snippets, digests. Column expressions wherever Spark has them."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tab and the ideographic space; runs of these and of spaces collapse. Newlines stay, as they end sentences.
_BLANKS = str.maketrans({"\t": " ", "　": " "})


def normalized(value: str | None) -> str:
    """NFKC, case folding, runs of blanks as one space, ends stripped."""
    text = unicodedata.normalize("NFKC", value or "").casefold().translate(_BLANKS)
    while "  " in text:
        text = text.replace("  ", " ")
    return text.strip()


def normalize_text(column: Column) -> Column:
    """`normalized` as an Arrow UDF: Spark has neither NFKC nor case folding."""
    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(normalized)

    return run(column)


def normalize_text_simple(column: Column) -> Column:
    """The same by built-in functions, for text that NFKC leaves alone and that folds as it lowers."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(column, F.lit(""))), "[\\t　 ]+", " "), r"(?U)^\s+|\s+$", "")


def cell(column: Column) -> Column:
    """A CSV cell: null as empty, stripped, `="..."` unwrapped, stripped again."""
    strip = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    bare = strip(F.coalesce(column, F.lit("")))
    return F.when(bare.startswith('="') & bare.endswith('"'), strip(F.substring(bare, F.lit(3), F.length(bare) - 3))).otherwise(bare)


def first_filled(*columns: Column) -> Column:
    """The first of the columns that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def digest(*parts: Column) -> Column:
    """SHA-256 in hexadecimal of the parts joined by `|`."""
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]).cast("binary"), 256)


def stratum(*parts: Column) -> Column:
    return F.concat_ws("|", *[p.cast("string") for p in parts])


def snippet(text: Column, start: Column, end: Column, size: int = 36) -> Column:
    """Text around [start, end), newlines as spaces."""
    left = F.greatest(start - size, F.lit(0))
    return F.replace(F.substring(text, left + 1, F.least(F.length(text), end + size) - left), F.lit("\n"), F.lit(" "))


def scope_snippet(text: Column, scope_start: Column, scope_end: Column, start: Column, end: Column, size: int = 120) -> Column:
    """Text around [start, end) inside its scope, an ellipsis on each clipped side."""
    left, right = F.greatest(scope_start, start - size), F.least(scope_end, end + size)
    body = F.replace(F.substring(text, left + 1, right - left), F.lit("\n"), F.lit(" "))
    dots = lambda clipped: F.when(clipped, F.lit("…")).otherwise(F.lit(""))
    return F.concat(dots(left > scope_start), body, dots(right < scope_end))


def span_distance(start: Column, end: Column, other_start: Column, other_end: Column) -> Column:
    return F.greatest(other_start - end, start - other_end, F.lit(0))


def spans_overlap(start: Column, end: Column, other_start: Column, other_end: Column) -> Column:
    return (start < other_end) & (other_start < end)


def text_hash(*fields: Column) -> Column:
    """SHA-256 of the fields, each NFKC-normalised with white space collapsed, joined by newlines."""
    @F.pandas_udf("string")
    def flat(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda v: " ".join(unicodedata.normalize("NFKC", v or "").split()))

    return F.sha2(F.concat_ws("\n", *[flat(F.coalesce(f.cast("string"), F.lit(""))) for f in fields]).cast("binary"), 256)


def format_float(column: Column) -> Column:
    """Twelve significant digits without trailing zeros, as C's %.12g prints them."""
    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda v: None if pd.isna(v) else f"{v:.12g}")

    return run(column.cast("double"))


def blake2b(column: Column, size: int) -> Column:
    """BLAKE2b of a string, in hexadecimal: not among Spark's hashes."""
    import hashlib

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda v: hashlib.blake2b((v or "").encode(), digest_size=size).hexdigest())

    return run(column)
