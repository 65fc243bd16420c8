"""Dictionary matching with context evidence.

The main form works on the texts of many rows, a bounded number of characters at a time: they are put into one string, an automaton
goes over it once for keywords and over each scope for context words, and places are arrays from there on. Scopes come from a search among
the places of sentence marks, context words meet keywords by intervals, and of a keyword's hits the first that passes is kept.
`keyword_spans` is a form without Python for lexicons and texts where that matters more.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from ..functions.text import normalized
from ..sources.taxonomy import Taxonomy

#: Characters that end a sentence, after NFKC.
BOUNDARIES = "。！？!?；;\n\r"
CONTEXT_HIT = "struct<context_id:string,kind:string,keyword:string,start:int,end:int,distance:int,snippet:string,source_ids:array<string>>"
KEYWORD_HIT = f"struct<group_id:string,tier:string,keyword:string,field:string,snippet:string,source_ids:array<string>,context_ids:array<string>,context_scope:string,context_snippet:string,context_hits:array<{CONTEXT_HIT}>>"
DIAGNOSTIC_HIT = "struct<pattern_id:string,keyword:string,field:string,snippet:string>"


#: Characters that are gone over together.
AT_ONCE = 1 << 18
#: Between the texts of a batch: no character, so part of no text and no keyword.
BETWEEN = "\uffff"


class Matcher:
    """All places of many keywords in a string."""

    def __init__(self, keywords: Iterable[str]):
        self.keywords = [k for k in dict.fromkeys(keywords) if k]
        self.lengths = np.array([len(k) for k in self.keywords], np.int64)
        self.automaton = None
        try:
            import ahocorasick

            self.automaton = ahocorasick.Automaton()
            for number, k in enumerate(self.keywords):
                self.automaton.add_word(k, number)
            if self.keywords:
                self.automaton.make_automaton()
        except ImportError:
            pass

    def everywhere(self, text: str, parts: list[tuple[int, int]] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(part, start, keyword number) of every occurrence inside each part of the text, overlapping ones too, by start and then longest first."""
        found: list[tuple[int, int, int]] = []
        for p, (low, high) in enumerate([(0, len(text))] if parts is None else parts):
            if self.automaton is None:
                found += [(p, m.start() + len(k) - 1, n) for n, k in enumerate(self.keywords) for m in re.compile(f"(?={re.escape(k)})").finditer(text, low, high)]
            elif self.keywords:
                found += [(p, low + last, n) for last, n in self.automaton.iter(text[low:high])]
        part, last, number = np.array(found, np.int64).reshape(-1, 3).T
        start = last - self.lengths[number] + 1 if len(number) else last
        order = np.lexsort((-self.lengths[number], start, part)) if len(number) else np.zeros(0, np.int64)
        return part[order], start[order], number[order]

    def leftmost(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(start, keyword number) of leftmost, of equal starts longest, occurrences that do not overlap."""
        _, start, number = self.everywhere(text)
        first = np.flatnonzero(np.diff(start, prepend=-1))  # of equal starts
        start, number = start[first], number[first]
        after = np.searchsorted(start, start + self.lengths[number]).tolist()
        taken, i = [], 0
        while i < len(after):
            taken.append(i)
            i = after[i]
        return start[taken], number[taken]

    def spans(self, text: str) -> list[tuple[int, int]]:
        start, number = self.leftmost(text)
        return list(zip(start.tolist(), (start + self.lengths[number]).tolist()))


class Texts:
    """The texts of a batch in one string, with where each begins and ends and where its sentence marks are."""

    def __init__(self, texts: list[str]):
        self.whole = BETWEEN.join(texts)
        self.ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        self.starts = np.r_[0, self.ends[:-1] + 1] if texts else np.zeros(0, np.int64)
        codes = np.frombuffer(self.whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.marks = np.flatnonzero(np.isin(codes, [ord(c) for c in BOUNDARIES]))

    def of(self, places: np.ndarray) -> np.ndarray:
        """Number of the text at each place."""
        return np.searchsorted(self.ends, places)

    def scopes(self, start: np.ndarray, end: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(from, to, whether a sentence): between the nearest marks in the text or its ends; without any mark, a window around the span."""
        text = self.of(start)
        low, high = self.starts[text], self.ends[text]
        marks = np.r_[-1, self.marks, len(self.whole) + 1]
        before, after = marks[np.searchsorted(marks, start) - 1], marks[np.searchsorted(marks, end)]
        left, right = before >= low, after < high
        sentence = left | right
        wide = np.maximum(low, start - window), np.minimum(high, end + window)
        return np.where(sentence, np.where(left, before + 1, low), wide[0]), np.where(sentence, np.where(right, after, high), wide[1]), sentence

    def around(self, text: int, start: int, end: int, size: int = 36) -> str:
        return self.whole[max(self.starts[text], start - size) : min(self.ends[text], end + size)].replace("\n", " ")


class Evidence:
    """A taxonomy compiled for one worker."""

    def __init__(self, taxonomy: Taxonomy):
        self.window = taxonomy.window
        self.terms, self.diagnostics = Matcher(taxonomy.terms), Matcher(taxonomy.diagnostics)
        self.groups = [taxonomy.terms[k] for k in self.terms.keywords]
        self.patterns = [taxonomy.diagnostics[k] for k in self.diagnostics.keywords]
        self.lexicons = [lexicon for lexicon, _ in taxonomy.contexts]
        # a word of several lexicons is found once and counts in each
        self.contexts = Matcher(w for _, words in taxonomy.contexts for w in words)
        self.in_lexicon = [np.array([w in words for w in self.contexts.keywords], bool) for words in (set(words) for _, words in taxonomy.contexts)]

    def words(self, texts: Texts, scopes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each lexicon (scope, start, end) of its words in each scope, read from its beginning: leftmost, longest, none overlapping."""
        part, place, number = self.contexts.everywhere(texts.whole, scopes.tolist())
        found = []
        for has in self.in_lexicon:
            own = np.flatnonzero(has[number])
            last, free, taken = -1, 0, []
            for i, s, a, b in zip(own.tolist(), part[own].tolist(), place[own].tolist(), (place[own] + self.contexts.lengths[number[own]]).tolist()):
                if s != last or a >= free:
                    last, free = s, b
                    taken.append(i)
            own = np.array(taken, np.int64)
            found.append((part[own], place[own], place[own] + self.contexts.lengths[number[own]]))
        return found

    def keyword_hits(self, texts: Texts, field: str) -> list[list[dict]]:
        """For each text its keyword hits by place: of a keyword the first whose group asks for no context or has one of those asked for.

        Whether a hit has a context is counted: its scope's words end in order, so those before it and those after it are known
        by search. Words are listed for the kept hits alone, else a long sentence would give its hits times its words.
        """
        start, number = self.terms.leftmost(texts.whole)
        gated = np.array([g["match_policy"]["mode"] == "cooccurrence" for g in self.groups] or [False])
        once = lambda i: np.sort(i[np.unique(texts.of(start[i]) * np.int64(len(self.terms.keywords)) + number[i], return_index=True)[1]])
        asks = gated[number]
        tried = np.sort(np.r_[once(np.flatnonzero(~asks)), np.flatnonzero(asks)])
        start, number, asks = start[tried], number[tried], asks[tried]
        end, text = start + self.terms.lengths[number], texts.of(start)
        low, high, sentence = texts.scopes(start, end, self.window)
        scopes, mine = np.unique(np.stack([low, high], axis=1), axis=0, return_inverse=True)
        mine, wide = mine.reshape(-1), np.int64(len(texts.whole) + 1)
        reach = []  # for each lexicon: its words' starts and ends, and for each hit the first in its scope, those before it, the first after it, the last
        for part, a, b in self.words(texts, scopes):
            reach.append((a, b, np.searchsorted(part, mine), np.searchsorted(part * wide + b, mine * wide + start, side="right"), np.searchsorted(part * wide + a, mine * wide + end), np.searchsorted(part, mine, side="right")))
        there = {x["id"]: np.zeros(len(start), bool) for x in self.lexicons}
        for x, (_, _, first, before, after, last) in zip(self.lexicons, reach):
            there[x["id"]] |= (before > first) | (last > after)
        met = {i: [c for c in self.groups[number[i]]["match_policy"].get("required_any", []) if c in there and there[c][i]] for i in np.flatnonzero(asks).tolist()}
        kept = once(np.array([i for i in range(len(start)) if i not in met or met[i]], np.int64))
        near: dict[int, list[dict]] = {}
        for i in kept.tolist():
            t = text[i]
            found = [(a[j], -b[j], x["id"], x) for x, (a, b, first, before, after, last) in zip(self.lexicons, reach) for j in (*range(first[i], before[i]), *range(after[i], last[i]))]
            near[i] = [{"context_id": name, "kind": x["kind"], "keyword": texts.whole[a:-b], "start": a - texts.starts[t], "end": -b - texts.starts[t], "distance": max(a - end[i], start[i] + b, 0), "snippet": texts.around(t, a, -b), "source_ids": list(x.get("source_ids", []))} for a, b, name, x in sorted(found, key=lambda f: f[:3])]
        out: list[list[dict]] = [[] for _ in texts.starts]
        for i in kept.tolist():
            group, t = self.groups[number[i]], text[i]
            a, b = max(low[i], start[i] - 120), min(high[i], end[i] + 120)
            clipped = ("…" if a > low[i] else "") + texts.whole[a:b].replace("\n", " ") + ("…" if b < high[i] else "")
            out[t].append({"group_id": group["id"], "tier": group["tier"], "keyword": self.terms.keywords[number[i]], "field": field, "snippet": texts.around(t, start[i], end[i]), "source_ids": list(group.get("source_ids", [])), "context_ids": met.get(i, []), "context_scope": "sentence" if sentence[i] else "window", "context_snippet": clipped, "context_hits": near[i]})
        return out

    def diagnostic_hits(self, texts: Texts, field: str) -> list[list[dict]]:
        """For each text the first place of each diagnostic keyword."""
        start, number = self.diagnostics.leftmost(texts.whole)
        text = texts.of(start)
        _, firsts = np.unique(text * np.int64(max(len(self.diagnostics.keywords), 1)) + number, return_index=True)
        out: list[list[dict]] = [[] for _ in texts.starts]
        for i in np.sort(firsts).tolist():
            a, b = start[i], start[i] + self.diagnostics.lengths[number[i]]
            out[text[i]].append({"pattern_id": self.patterns[number[i]]["id"], "keyword": self.diagnostics.keywords[number[i]], "field": field, "snippet": texts.around(text[i], a, b)})
        return out


_compiled: dict[str, Evidence] = {}


def _evidence(taxonomy: Taxonomy) -> Evidence:
    """Compiled once in a worker."""
    key = repr((taxonomy.docs, taxonomy.ipc))
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = Evidence(taxonomy)
    return _compiled[key]


def runs(columns: list[pd.Series | pa.Array]) -> Iterator[slice]:
    """Consecutive rows of at most `AT_ONCE` characters together, or a single one: a worker's memory does not follow the size of an Arrow batch."""
    ends = np.cumsum(sum(pc.utf8_length(c if isinstance(c, pa.Array) else pa.array(c, pa.string())).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns))
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + AT_ONCE, side="right")))
        yield slice(first, last)
        first = last


def found(columns: list[pa.Array], names: list[str], taxonomy: Taxonomy, kind: pa.DataType) -> Iterator[pa.Array]:
    """`evidence` of one Arrow batch, run by run: only a run's texts become Python's, the others stay in Arrow's buffers.

    Columns beyond the names are normalised and not searched.
    """
    compiled = _evidence(taxonomy)
    for rows in runs(columns):
        hits, notes, plain = [], [], []
        for i, column in enumerate(columns):
            values = [normalized(v) for v in column[rows].to_pylist()]
            if i >= len(names):
                plain.append(values)
                continue
            texts = Texts(values)
            hits.append(compiled.keyword_hits(texts, names[i]))
            notes.append(compiled.diagnostic_hits(texts, names[i]))
        parts = [[sum(x, []) for x in zip(*hits)], [sum(x, []) for x in zip(*notes)], *[[list(x) for x in zip(*plain)]] * bool(plain)]
        yield pa.StructArray.from_arrays([pa.array(p, f.type) for p, f in zip(parts, kind)], fields=list(kind))


def evidence(fields: dict[str, Column], taxonomy: Taxonomy, plain: Iterable[Column] = ()) -> Column:
    """Struct of `keyword_hits` and `diagnostic_hits` over several text fields, in their order.

    With `plain` also `normalized`, an array of those columns as `normalize_text` has them: each such function by itself would
    have a Python worker of its own beside this one.
    """
    names, plain = list(fields), list(plain)
    ddl = f"struct<keyword_hits:array<{KEYWORD_HIT}>,diagnostic_hits:array<{DIAGNOSTIC_HIT}>{',normalized:array<string>' * bool(plain)}>"
    kind = to_arrow_type(DataType.fromDDL(ddl))

    @F.arrow_udf(ddl)
    def run(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for part in parts:
            yield from found([part] if isinstance(part, pa.Array) else list(part), names, taxonomy, kind)  # a single field comes bare

    return run(*[F.coalesce(c.cast("string"), F.lit("")) for c in [*fields.values(), *plain]])


def alternation(keywords: Iterable[str]) -> str:
    """A pattern that matches the longest of the keywords at a place; fit for Java and for RE2."""
    return "|".join(re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", k) for k in sorted(dict.fromkeys(keywords), key=lambda k: (-len(k), k)))


def keyword_spans(text: Column, keywords: Iterable[str]) -> Column:
    """Array of (keyword, start) of all leftmost-longest occurrences, without Python.

    What a pattern splits off and what it matches alternate, so starts are running lengths. These are summed up in blocks of
    about the root of their number: an array that grows by one is copied each time.
    """
    pattern = alternation(keywords)
    let = lambda value, body: F.element_at(F.transform(F.array(value), body), 1)

    def running(lengths: Column, base: Column) -> Column:
        """Sums of all lengths before each place, from `base` on."""
        step = lambda acc, n: F.struct((acc.at + n).alias("at"), F.concat(acc.found, F.array(acc.at)).alias("found"))
        return F.aggregate(lengths, F.struct(base.alias("at"), F.array().cast("array<int>").alias("found")), step).found

    def in_blocks(lengths: Column, size: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(1), F.size(lengths), size), lambda i: F.slice(lengths, i, size))
        whole = lambda of: F.transform(of, lambda b: F.aggregate(b, F.lit(0), lambda x, n: x + n))
        return let(blocks, lambda of: F.flatten(F.zip_with(of, running(whole(of), F.lit(0)), running)))

    def located(m: Column, gaps: Column) -> Column:
        none = F.array().cast("array<struct<keyword:string,start:int>>")
        lengths = F.transform(m, lambda k, i: F.length(F.get(gaps, i)) + F.length(k))
        ends = let(lengths, lambda n: in_blocks(n, F.ceil(F.sqrt(F.size(n))).cast("int")))
        spans = let(ends, lambda at: F.transform(m, lambda k, i: F.struct(k.alias("keyword"), (F.get(at, i) + F.length(F.get(gaps, i))).alias("start"))))
        return F.when(F.size(m) > 0, spans).otherwise(none)

    return let(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), lambda m: let(F.split(text, pattern, -1), lambda gaps: located(m, gaps)))


def scope(text: Column, start: Column, end: Column, window: int) -> Column:
    """Struct (start, end, mode) of a keyword's scope, by built-in functions that go over the text once.

    A pattern for what follows the last mark would be tried at every place, each time as far as the next mark.
    """
    marked = F.translate(text, BOUNDARIES, "\n" * len(BOUNDARIES))
    before = F.substring(marked, F.lit(1), start)
    after = F.substring(marked, end + 1, F.length(text))
    left = F.length(before) - F.length(F.substring_index(before, "\n", -1))  # one past the last mark
    right = end + F.length(F.substring_index(after, "\n", 1))
    sentence = (left > 0) | F.contains(after, F.lit("\n"))
    return F.struct(F.when(sentence, left).otherwise(F.greatest(start - window, F.lit(0))).alias("start"), F.when(sentence, right).otherwise(F.least(F.length(text), end + window)).alias("end"), F.when(sentence, "sentence").otherwise("window").alias("mode"))


def exploded_hits(routed: DataFrame, keep: list[str]) -> DataFrame:
    """A row for each keyword hit.

    A plain explode would have the optimizer ask for rows with hits beneath it, that is, find the evidence twice, in two Python workers.
    """
    hits = routed.select(*keep, F.posexplode_outer("keyword_hits").alias("hit_number", "hit"))
    return hits.where("hit_number is not null").select(*keep, "hit_number", "hit.*")
