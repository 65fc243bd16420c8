"""Chat formatting by schema fingerprints.

A row's layout is told from the nested field paths that it fills in. Of all paths only those count that some layout
requires (its marks), so keys, dates and other columns beside them change nothing. The hash of the sorted
marks is looked up in a table of declarative mappings, which turn heterogeneous prompt, instruction and message
layouts into canonical turns (conversation, position, role, text). Where a row fills in no other layout's marks, the
columns of turn rows count by being there, so that a turn may be null. All of it is column expressions.

The template is, for each turn, `### ROLE: TEXT</turn>` and a newline. Inside texts and roles the escape
character, `###`, `</turn>` (and in roles `: `) become two-character escapes; as each escape starts with a
backslash and every backslash of the text is escaped itself, unescaping is exact and no text can imitate a
marker. The loss mask lists the spans (code points of the formatted text) of all assistant texts.

Defined cases: a null text or role is empty; turns of equal position are ordered by role, then text; repeated
rows are repeated turns; a null conversation id is a conversation of its own; rows whose marks fit no mapping
give no turns, are returned by `unmatched` and counted by layout in `layout_counts`; very long texts are formatted
whole, one conversation in one row (its digest needs the whole text in order); columns that no layout names are ignored,
whatever they are called.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import fresh, let

END = "</turn>"
MARK = "###"
#: Escapes, in the order in which they are put in.
ESCAPES = (("\\", "\\0"), (MARK, "\\1"), (END, "\\2"))
ROLE_ESCAPES = (*ESCAPES, (": ", "\\3"))
# Other names of the three roles.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant"}


@dataclass(frozen=True)
class Layout:
    """How one layout becomes turns.

    Either the row is one turn (`turn`: paths of position, role and text), or it holds an array of turns
    (`each`: the array and its role and text fields), or named fields are turns (`fields`: role and path in order;
    several paths under one role are joined by a blank line). `before` are fields that come first. `required` are the
    marks that select the layout; `optional` ones are used where they are filled in.
    """

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turn: tuple[str, str, str] | None = None
    each: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    before: tuple[tuple[str, tuple[str, ...]], ...] = ()

    @property
    def paths(self) -> tuple[str, ...]:
        return self.required + self.optional


LAYOUTS = (
    Layout("turn_rows", ("role", "text"), ("turn",), turn=("turn", "role", "text")),
    Layout("messages", ("messages[].role", "messages[].content"), ("system",), each=("messages", "role", "content"), before=(("system", ("system",)),)),
    Layout("from_value", ("conversations[].from", "conversations[].value"), ("system",), each=("conversations", "from", "value"), before=(("system", ("system",)),)),
    Layout("instruction", ("instruction", "output"), ("input", "system"), fields=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("prompt_completion", ("prompt", "completion"), ("system",), fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt_response", ("prompt", "response"), ("system",), fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question_answer", ("question", "answer"), ("context",), fields=(("user", ("context", "question")), ("assistant", ("answer",)))),
)


def paths_of(schema: T.StructType, prefix: str = "") -> list[str]:
    """Nested field paths of a schema; `[]` stands for an array's elements."""
    out = []
    for f in schema.fields:
        kind, path = f.dataType, prefix + f.name
        while isinstance(kind, T.ArrayType):
            kind, path = kind.elementType, path + "[]"
        out += paths_of(kind, path + ".") if isinstance(kind, T.StructType) else [path]
    return out


def hashed(paths: Column) -> Column:
    return F.xxhash64(F.array_join(F.array_sort(paths), "\n"))


def fingerprint(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Hash of the sorted marks that a row fills in; what an array holds counts as filled in if the array is there."""
    there = set(paths_of(df.schema))
    by_row = sorted({p for layout in layouts if not layout.turn for p in layout.required} & there)
    by_schema = sorted({p for layout in layouts if layout.turn and set(layout.required) <= there for p in layout.required})
    texts = lambda paths: F.array(*map(F.lit, paths)).cast("array<string>")
    if not by_row:
        return hashed(texts(by_schema))
    filled = F.array_compact(F.array(*[F.when(df[p.split("[]")[0]].isNotNull(), F.lit(p)) for p in by_row]))
    return hashed(F.when(F.size(filled) > 0, filled).otherwise(texts(by_schema)))


def _known(df: DataFrame, layouts: tuple[Layout, ...]) -> list[Layout]:
    """Layouts that the schema can fill, one for each set of marks."""
    there, out = set(paths_of(df.schema)), {}
    for layout in layouts:
        if set(layout.required) <= there:
            out.setdefault(tuple(sorted(layout.required)), layout)
    return list(out.values())


def _layout_of(df: DataFrame, layouts: tuple[Layout, ...]) -> Column:
    """Number of the mapping that a row's fingerprint selects; null if none does."""
    pairs = [(hashed(F.array(*map(F.lit, layout.required))), F.lit(k)) for k, layout in enumerate(_known(df, layouts))]
    return F.element_at(F.create_map(*itertools.chain(*pairs)), fingerprint(df, layouts)) if pairs else F.lit(None).cast("int")


def _role(role: Column) -> Column:
    names = F.create_map(*itertools.chain(*((F.lit(a), F.lit(b)) for a, b in ROLES.items())))
    return F.coalesce(names[role], role, F.lit(""))


def _turns(layout: Layout) -> Column:
    """Array of (turn, role, text) of a row in this layout."""
    one = lambda turn, role, text: F.struct(turn.cast("long").alias("turn"), role.cast("string").alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    if layout.turn:
        turn, role, text = (F.col(p) if p in layout.paths else F.lit(None) for p in layout.turn)
        return F.array(one(turn, _role(role.cast("string")), text))
    named = [F.when(F.coalesce(*[F.col(p) for p in paths]).isNotNull(), one(F.lit(k), F.lit(role), F.concat_ws("\n\n", *[F.when(F.col(p) != "", F.col(p)) for p in paths]))) for k, (role, paths) in enumerate(layout.fields)]
    if layout.fields:
        return F.array_compact(F.array(*named))
    array, role, text = layout.each
    first = F.array_compact(F.array(*[F.when(F.col(p[0]).isNotNull(), one(F.lit(-1), F.lit(r), F.col(p[0]))) for r, p in layout.before]))
    return F.concat(first, F.transform(F.filter(F.col(array), lambda m: m.isNotNull()), lambda m, i: one(i, _role(m[role]), m[text])))


def canonical_turns(df: DataFrame, conversation: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, turn, role, text) of all rows that a mapping fits; the others are those of `unmatched`."""
    turns, have = F.lit(None).cast("array<struct<turn:bigint,role:string,text:string>>"), set(paths_of(df.schema))
    number, conv = fresh("_layout", df.columns), fresh("_conv", df.columns)
    for k, layout in enumerate(_known(df, layouts)):
        lean = Layout(layout.name, layout.required, tuple(p for p in layout.optional if p in have), layout.turn, layout.each, _present(layout.fields, have), _present(layout.before, have))
        turns = F.when(F.col(number) == k, _turns(lean)).otherwise(turns)
    marked = df.withColumns({conv: conversation, number: _layout_of(df, layouts)})
    return marked.select(F.col(conv).alias("conv_id"), F.explode(turns).alias("_t")).select("conv_id", "_t.turn", "_t.role", "_t.text")


def layout_counts(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(layout, rows): how many rows each mapping takes; under `unmatched` those that none does."""
    names = F.array(*[F.lit(x.name) for x in _known(df, layouts)]).cast("array<string>")
    layout = F.coalesce(F.get(names, _layout_of(df, layouts)), F.lit("unmatched"))
    return df.select(layout.alias("layout")).groupBy("layout").agg(F.count("*").alias("rows"))


def _present(fields: tuple, have: set) -> tuple:
    lean = ((role, tuple(p for p in paths if p in have)) for role, paths in fields)
    return tuple((role, paths) for role, paths in lean if paths)


def unmatched(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Rows whose fingerprint selects no mapping."""
    return df.where(_layout_of(df, layouts).isNull())


def escaped(text: Column, escapes: tuple = ESCAPES) -> Column:
    for what, by in escapes:
        text = F.replace(text, F.lit(what), F.lit(by))
    return text


def unescaped(text: Column, escapes: tuple = ESCAPES) -> Column:
    for what, by in reversed(escapes):
        text = F.replace(text, F.lit(by), F.lit(what))
    return text


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): a row for each conversation; loss is the array of masked spans (start, end).

    Turns are rendered where they lie; a running length by conversation gives the spans, and the
    aggregation that follows uses the same partitioning.
    """
    head = F.concat(F.lit(f"{MARK} "), escaped(F.col("role"), ROLE_ESCAPES), F.lit(": "))
    rendered = turns.select("conv_id", "turn", "role", "text", head.alias("_head"), escaped(F.col("text")).alias("_body"))
    rendered = rendered.withColumn("_piece", F.concat("_head", "_body", F.lit(f"{END}\n")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    lengths = rendered.withColumns({"_long": F.length("_piece"), "_masked": F.when(F.col("role") == "assistant", F.length("_body")), "_lead": F.length("_head")}).drop("_head", "_body")
    placed = lengths.withColumns({"_n": F.row_number().over(order), "_start": F.sum("_long").over(order.rowsBetween(Window.unboundedPreceding, -1))})
    start = F.coalesce("_start", F.lit(0)) + F.col("_lead")
    span = F.when(F.col("_masked").isNotNull(), F.struct(start.cast("long").alias("start"), (start + F.col("_masked")).cast("long").alias("end")))
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("_n", "_piece", span.alias("_span")))).alias("_all"))
    return whole.select("conv_id", F.array_join("_all._piece", "").alias("formatted"), F.array_compact("_all._span").alias("loss"))


def parsed(text: Column) -> Column:
    """Array of (role, text) read back from a formatted text."""
    pieces = F.filter(F.split(text, f"{END}\n", -1), lambda p: p != "")
    body = lambda p: F.substring(p, len(MARK) + 2, F.length(p))
    at = lambda p: F.instr(body(p), ": ")
    return F.transform(pieces, lambda p: F.struct(unescaped(F.substring(body(p), F.lit(1), at(p) - 1), ROLE_ESCAPES).alias("role"), unescaped(F.substring(body(p), at(p) + 2, F.length(p))).alias("text")))


def masked(text: Column, loss: Column) -> Column:
    """Texts under the loss mask, unescaped. Four bytes a code point let every span be cut out directly.

    A decoder takes U+FEFF at the start of what it reads for a byte-order mark, so each span is read behind a letter.
    """
    wide = F.encode(text, "UTF-32")
    cut = lambda w, s: F.concat(F.lit(b"\x00\x00\x00x"), F.substring(w, (s.start * 4 + 1).cast("int"), ((s.end - s.start) * 4).cast("int")))
    read = lambda b: let(F.decode(b, "UTF-32"), lambda t: F.substring(t, F.lit(2), F.length(t)))
    return let(wide, lambda w: F.transform(loss, lambda s: unescaped(read(cut(w, s)))))
