"""Personal data by boosted trees over candidate spans.

Fixed patterns give the base spans of four kinds, which always stay. Beyond them, high-recall generators
propose overlapping candidates (addresses spelt with "at" and "dot", numbers without a plus sign or with unusual
separators); boosted trees judge each by its format and its context, and a threshold per kind, calibrated to
precision on sentences from templates that the trees never saw, selects what is added. Of overlapping candidates the
likeliest stays, and none overlaps a base span.

The trees learn from sentences made here by rule (`examples`), so fitting does not grow with the corpus; the
same column expressions measure those sentences and the documents. Patterns give no positions in Spark, so a
span's start is the running length of what a pattern splits off and what it matches, in code points.

Defined cases: null text is empty and has no spans; very long texts are searched whole (run-start and
possessive forms keep the patterns linear on long runs); repeated rows are each returned; a null
doc_id is returned; an empty table gives no rows; other columns are ignored, or kept by `redacted`.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import first_at, let, packed, scanned, text_of
from .trees import boost, sigmoid, tree_column, value_of

KINDS = ("email", "ip", "card", "phone")
#: Base patterns. Where a run of one class must end in a certain character, the run is entered only at its start
#: (or where the last match ended) and not given back: the matches are those of the plain pattern.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a base pattern to be tried.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
GENERATORS = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\s?[\[({]\s?(?:at|@)\s?[\])}]\s?|\sat\s)[A-Za-z0-9-]{1,63}+(?:(?:\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?|\sdot\s|\.)[A-Za-z0-9-]{1,63}+){1,5}",
    "ip": r"(?i)(?<![0-9A-Za-z.])[0-9]{1,3}(?:\s?(?:[\[({]\s?(?:dot|\.)\s?[\])}]|\sdot)\s?[0-9]{1,3}){3}(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z.+-])[0-9]{4}(?:[ ._/-]{1,3}[0-9]{2,6}){2,4}(?![0-9A-Za-z])",
    # 7 to 15 digits however they are grouped, or any groups of digits with signs between
    "phone": r"(?<![0-9A-Za-z+/-])(?<![0-9]\.)(?:\+?(?:\((?=[0-9]{1,5}\)))?[0-9](?:\)?[ ./-]{0,2}\(?[0-9]){6,14}(?![./-]?[0-9A-Za-z])|(?<!\.)(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,5}\)?){1,5}(?!\.?[0-9A-Za-z]))",
}
#: Each is implied by its generator, so that it saves work and changes no result.
GENERATOR_HINT = {"email": r"(?i)[\[({]\s?(?:at|@)\s?[\])}]|\sat\s[A-Za-z0-9-]++(?:\s?[\[({]\s?(?:dot|\.)\s?[\])}]|\sdot\s|\.)", "ip": r"(?i)[0-9]\s?(?:[\[({]\s?(?:dot|\.)\s?[\])}]|\sdot)\s?[0-9]", "card": r"[0-9]{4}[ ._/-]{1,3}[0-9]{2}", "phone": r"[0-9]\)?[ ./-]{1,2}\(?[0-9]|[0-9](?:\)?[ ./-]{0,2}\(?[0-9]){6}"}
#: Words before a candidate, by what they speak for.
CONTEXT = {
    "phone": r"(?i)(?:\btel|phone|\bcall|\bfax|mobil|\bcell|whatsapp|\bring|\bdial|telefon|t.l.phone|tel.fono|handy|\bsms|\btext me)",
    "card": r"(?i)(?:\bcard|visa|master|amex|credit|debit|karte|carte|tarjeta|\bpay)",
    "ip": r"(?i)(?:\bip\b|host|server|\baddr|login|client)",
    "email": r"(?i)(?:mail|contact|write|reach|correo|courriel|@)",
    "other": r"(?i)(?:order|invoice|isbn|issn|version|\bv\b|\bid\b|\bno\b|\bref|serial|date|page|\bsku|ticket|section|figure|table|rfc|build|release|between|score|from|range|part)",
}
#: Spans of a kind up to which they are simply gone through.
FEW = 16
PRECISION = 0.98
ROUNDS, DEPTH = 40, 3


def _spans(text: Column, pattern: str) -> Column:
    """Array of (start, end, match, before, after) of all matches, in order; contexts are cut from the text between matches."""
    part = "start:int,end:int,match:string,before:string,after:string"

    def located(m: Column, gaps: Column) -> Column:
        def step(at: Column, i: Column) -> tuple[Column, Column]:
            start = at.at + F.length(F.get(gaps, i))
            end = start + F.length(F.get(m, i))
            one = F.struct(start.alias("start"), end.alias("end"), F.get(m, i).alias("match"), F.right(F.get(gaps, i), F.lit(40)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(12)).alias("after"))
            return F.struct(end.alias("at")), one

        return scanned(F.sequence(F.lit(0), F.size(m) - 1), F.struct(F.lit(0).alias("at")), step, f"struct<{part}>")

    found = lambda m: F.when(F.size(m) > 0, let(F.split(text, pattern, -1), lambda gaps: located(m, gaps))).otherwise(_none())
    return let(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), found)


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,match:string,before:string,after:string>>")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def share(d: Column, i: Column) -> Column:
        v = F.coalesce(d.try_cast("int"), F.lit(0))
        return F.when(i % 2 == 0, v).otherwise(2 * v - F.when(v > 4, 9).otherwise(0))

    parts = F.transform(F.split(F.reverse(digits), ""), share)
    return F.coalesce(F.aggregate(parts, F.lit(0), lambda a, x: a + x) % 10 == 0, F.lit(False))


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    return {
        "email": F.lit(True),
        "ip": m.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"),
        "card": n.between(12, 19) & luhn(F.substring(_digits(m), 1, 20)),
        "phone": n.between(9, 15),
    }[kind]


def _bare(spans: Column, kind: str) -> Column:
    """(start, kind number, end), the order of the listing."""
    return F.transform(spans, lambda s: F.struct(s.start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s.end.alias("end")))


def base_spans(text: Column) -> dict[str, Column]:
    """By kind: array of (start, kind, end)."""
    out = {}
    for kind in KINDS:
        hint = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(HINT[kind])
        found = F.when(hint, _spans(text, BASE[kind])).otherwise(_none())
        out[kind] = _bare(F.filter(found, lambda s: _valid(kind, s.match)), kind)  # noqa: B023  called at once
    return out


def candidates_by_kind(text: Column) -> list[Column]:
    """For each kind the array of its generator's candidates: (kind, start, end, match, before, after), in order and apart from each other."""
    parts = []
    for k, kind in enumerate(KINDS):
        found = F.when(text.rlike(GENERATOR_HINT[kind]), _spans(text, GENERATORS[kind])).otherwise(_none())
        parts.append(F.transform(found, lambda s: F.struct(F.lit(k).alias("kind"), s.start.alias("start"), s.end.alias("end"), s.match.alias("match"), s.before.alias("before"), s.after.alias("after"))))  # noqa: B023
    return parts


def candidates(text: Column) -> Column:
    return F.concat(*candidates_by_kind(text))


def features(c: Column) -> list[Column]:
    """Format and context of a candidate, as numbers."""
    m, one = c.match, lambda b: F.when(b, 1.0).otherwise(0.0)
    count = lambda ch: (F.length(m) - F.length(F.replace(m, F.lit(ch), F.lit("")))).cast("double")
    digits = _digits(m)
    return [
        *[one(c.kind == k) for k in range(len(KINDS))],
        F.length(digits).cast("double"), F.length(m).cast("double"), F.size(F.split(m, "[^0-9]+")).cast("double"),
        *[count(ch) for ch in ".- /("],
        one(luhn(F.substring(digits, 1, 20))), one(m.rlike(r"(?:^|[^0-9])[0-9]{5}")), one(m.rlike(r"^[0-9]{4}(?:[^0-9]+[0-9]{4}){3}$")), one(m.rlike(r"^\(?[0-9]{3}\)?[^0-9]+[0-9]{3}[^0-9]+[0-9]{4}$")),
        one(m.rlike(r"^(?:19|20)[0-9]{2}[-/.][0-9]{2}[-/.]")), one(m.rlike(r"(?i)\b(?:com|org|net|edu|gov|info|io|de|fr|es|uk)$")), one(m.rlike(r"[\[({]")), one(m.startswith("+")),
        *[one(c.before.rlike(p)) for p in CONTEXT.values()],
        one(c.before.rlike(r"[A-Za-z0-9_]$")), one(c.after.rlike(r"^[A-Za-z0-9_%]")),
    ]


def examples(n: int = 1500, seed: int = 11) -> list[tuple[str, int]]:
    """(sentence, whether its candidates are personal data), made by rule."""
    rng = random.Random(seed)
    d = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def card() -> str:
        body = "4" + d(14)
        total = sum(int(c) if i % 2 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(body))
        s = body + str(-total % 10)
        return rng.choice([" / ", ".", "  ", "_", "/"]).join(s[i : i + 4] for i in range(0, 16, 4))

    at, dot = lambda: rng.choice([" (at) ", "[at]", " [at] ", "(at)", " at ", " (@) "]), lambda: rng.choice([" (dot) ", "[dot]", " [dot] ", "(dot)", " dot "])
    name = lambda: rng.choice(["jo.doe", "info", "anna_b", "k.li", "sales", "m22", "press"])
    octets = lambda: [str(rng.randrange(256)) for _ in range(4)]
    phone = lambda: rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}"]).format(d(3), d(3), d(4))
    local = lambda: rng.choice(["0{}/{}", "0{} {}", "0{}-{}"]).format(d(3), d(5))
    site = lambda: rng.choice(["example", "mail", "uni"]) + "." + rng.choice(["com", "org", "de", "fr", "net"])
    run = lambda: rng.choice([d(10), "0" + d(10), d(7), f"0{d(2)} {d(7)}", f"0{d(3)} {d(7)}", f"0{d(2)}/{d(rng.choice([6, 7, 8]))}", f"({d(3)}){d(3)}-{d(4)}"])
    good = [
        lambda: rng.choice(["mail me: ", "contact ", "write to ", "", "reach us at "]) + name() + at() + rng.choice(["example", "mail", "uni"]) + dot() + rng.choice(["com", "org", "de", "fr", "net"]),
        lambda: rng.choice(["server ip ", "host ", "login from ", "client address "]) + rng.choice(["[.]", "(.)", " dot ", "[dot]"]).join(octets()),
        lambda: rng.choice(["card ", "visa no ", "credit card: ", "pay with ", ""]) + card(),
        lambda: rng.choice(["tel ", "phone: ", "call me on ", "fax ", "mobile ", "dial ", "whatsapp "]) + rng.choice([phone, local])(),
        lambda: rng.choice(["mail me: ", "contact ", "write to ", "email "]) + name() + " at " + site(),
        lambda: rng.choice(["tel ", "tel. ", "phone ", "call ", "fax ", "mobil ", "telefon "]) + run(),
        lambda: rng.choice(["", "", "tel "]) + f"+{rng.randrange(1, 99)} " + phone() + rng.choice(["", " " + ".".join(octets())]),
    ]
    bad = [
        lambda: rng.choice(["order ", "invoice ", "isbn ", "ref ", "serial ", "sku ", "part ", "ticket ", "version ", "page "]) + rng.choice([phone, local])(),
        lambda: rng.choice(["date ", "on ", "", "from "]) + rng.choice(["20{}-{}-{}", "{}/{}/20{}", "{}.{}.19{}"]).format(d(2), d(2), d(2)),
        lambda: rng.choice(["order ", "serial ", "the table ", "values ", "score "]) + " ".join(d(rng.choice([2, 3, 4])) for _ in range(rng.choice([2, 3, 4, 5]))),
        lambda: rng.choice(["order ", "serial ", "ref ", ""]) + rng.choice([" / ", ".", "_", "/"]).join(d(4) for _ in range(4)),
        lambda: rng.choice(["we met", "look", "they are", "sit"]) + " at " + rng.choice(["noon", "home", "school", "once"]) + rng.choice([" dot ", "."]) + rng.choice(["then", "and", "it", "matrix"]),
        lambda: rng.choice(["see ", "the score ", "section ", "values "]) + rng.choice([" ", "-", "/"]).join(d(rng.choice([2, 3])) for _ in range(rng.choice([2, 3]))),
        lambda: rng.choice(["we met", "look", "they are", "sold", "more"]) + " at " + site(),
        lambda: rng.choice(["order ", "invoice ", "isbn ", "ref ", "serial ", "sku ", "id ", "", "the ", "values "]) + rng.choice([run(), d(rng.choice([8, 9, 12, 13, 14])), f"{d(1)}.{d(rng.randrange(5, 12))}"]),
        lambda: rng.choice(["release ", "build ", "section ", "part "]) + rng.choice(["(.)", "[.]", " dot "]).join(d(rng.choice([1, 1, 2])) for _ in range(4)),
        lambda: rng.choice(["", "", "the ", "with "]) + phone().replace("(", "").replace(")", ""),
    ]
    return _sentences(good, bad, "the of and when und der les que con para this was".split(), n, rng)


def _sentences(good: list, bad: list, filler: list[str], n: int, rng: random.Random) -> list[tuple[str, int]]:
    out = []
    for _ in range(n):
        y = int(rng.random() < 0.5)
        words = lambda: " ".join(rng.choices(filler, k=rng.randrange(5)))
        out.append((f"{words()}, {rng.choice(good if y else bad)()} {words()}.", y))
    return out


def held_examples(n: int = 1500, seed: int = 23) -> list[tuple[str, int]]:
    """Like `examples`, from templates of their own: other words before, other spellings and groupings. For thresholds, never for the trees."""
    rng = random.Random(seed)
    d = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    name = lambda: rng.choice(["max.muster", "support", "p_lopez", "a.martin", "team42", "office"])
    host = lambda: rng.choice(["firma", "school", "acme-labs", "posta"])
    at, dot = lambda: rng.choice(["{at}", " [ at ] ", " (AT) ", " {@} "]), lambda: rng.choice(["{dot}", " [ dot ] ", " DOT ", "[.]"])
    octets = lambda: [str(rng.randrange(256)) for _ in range(4)]
    number = lambda: rng.choice([f"{d(4)} {d(6)}", f"{d(3)}/{d(3)}-{d(4)}", f"0{d(2)} {d(2)} {d(2)} {d(2)} {d(2)}", f"({d(4)}) {d(6)}", f"{d(3)} {d(3)} {d(3)}"])

    def card() -> str:
        body = rng.choice("5") + d(14)
        total = sum(int(c) if i % 2 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(body))
        s = body + str(-total % 10)
        return rng.choice([" . ", "--", " _", "/ "]).join(s[i : i + 4] for i in range(0, 16, 4))

    good = [
        lambda: rng.choice(["e-mail ", "courriel: ", "correo: ", "please reach ", "you can contact "]) + name() + at() + host() + dot() + rng.choice(["es", "uk", "io", "edu"]),
        lambda: rng.choice(["ip ", "the server ", "addr ", "seen client "]) + rng.choice(["{.}", "{dot}", " [.] ", "(dot)"]).join(octets()),
        lambda: rng.choice(["karte ", "carte: ", "tarjeta ", "amex ", "by debit "]) + card(),
        lambda: rng.choice(["ring ", "cell: ", "text me ", "handy ", "sms to ", "telefono: "]) + number(),
    ]
    bad = [
        lambda: rng.choice(["build ", "release ", "figure ", "between ", "id ", "no ", "range "]) + number(),
        lambda: rng.choice(["lot ", "case ", "chapter ", "items "]) + " ".join(d(rng.choice([2, 3, 4])) for _ in range(rng.choice([3, 4]))),
        lambda: rng.choice(["table ", "section ", "rfc "]) + rng.choice([" . ", "--", "/ "]).join(d(4) for _ in range(4)),
        lambda: rng.choice(["they stood", "he laughed", "all went well", "it ends"]) + " at " + rng.choice(["last", "night", "sea", "dawn"]) + rng.choice([" dot ", "."]) + rng.choice(["so", "but", "we", "later"]),
        lambda: rng.choice(["born ", "until ", "date "]) + f"{d(2)}.{d(2)}.20{d(2)}",
        lambda: rng.choice(["v ", "version "]) + rng.choice(["[.]", "{.}"]).join(d(1) for _ in range(4)),
    ]
    return _sentences(good, bad, "a in to for von mit pour dans los una it had".split(), n, rng)


class PiiModel:
    def __init__(self, start: float, trees: list, thresholds: list[float], report: dict | None = None):
        self.start, self.trees, self.thresholds, self.report = start, trees, thresholds, report or {}

    def probability(self, c: Column) -> Column:
        """A candidate's probability; features are worked out once."""
        names = [f"f{i}" for i in range(len(features(c)))]
        packed = F.struct(*[f.alias(n) for f, n in zip(features(c), names)])

        def total(x: Column) -> Column:
            cols, s = [x[n] for n in names], F.lit(self.start)
            for tree in self.trees:
                s = s + tree_column(tree, cols)
            return sigmoid(s)

        return let(packed, total)


def _measured(spark: SparkSession, made: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """(features, label, kind, sentence) of the candidates of made sentences, measured by the expressions that measure documents."""
    rows = spark.range(1).select(F.explode(F.lit([t for t, _ in made])).alias("text"))
    rows = rows.withColumn("c", F.explode(candidates(F.col("text"))))
    names = [f"f{i}" for i in range(len(features(F.col("c"))))]
    got = rows.select("text", "c.kind", *[f.alias(n) for f, n in zip(features(F.col("c")), names)]).collect()  # of made sentences
    label = dict(made)
    return np.array([[r[n] for n in names] for r in got]), np.array([label[r.text] for r in got], float), np.array([r.kind for r in got]), [r.text for r in got]


def train(spark: SparkSession) -> PiiModel:
    """Trees from `examples`; a threshold for each kind, the least that keeps `PRECISION` on `held_examples`. `report` says what they reach there."""
    held = held_examples()
    x, y, kinds, texts = _measured(spark, examples() + held)
    apart = np.isin(texts, [t for t, _ in held])
    start, trees = boost(x[~apart], y[~apart], ROUNDS, DEPTH)
    held_x, held_y, kind = x[apart], y[apart], kinds[apart]
    p = 1 / (1 + np.exp(-(start + sum(value_of(t, held_x) for t in trees))))
    thresholds, report = [], {}
    for k, name in enumerate(KINDS):
        own, truth = p[kind == k], held_y[kind == k]
        fine = [t for t in np.linspace(0.5, 0.99, 50) if (own >= t).any() and truth[own >= t].mean() >= PRECISION]
        thresholds.append(float(fine[0]) if fine else 1.0)
        kept = own >= thresholds[-1]
        report[name] = {"candidates": len(own), "threshold": thresholds[-1], "precision": float(truth[kept].mean()) if kept.any() else None, "recall": float(kept[truth > 0].mean()) if truth.any() else None}
    return PiiModel(start, trees, thresholds, report)


def meets(spans: Column, c: Column, test: Callable[[Column], Column]) -> Column:
    """Whether any of `spans`, which are in order and apart from each other, overlaps c and passes the test; by binary search where there are many.

    All overlaps together are no more than both families of spans, so a text's cost grows with its spans and not their square.
    """
    low = first_at(F.size(spans), lambda i: F.get(spans, i).end > c.start)
    high = first_at(F.size(spans), lambda i: F.get(spans, i).start >= c.end)
    found = lambda x: F.when(x.low < x.high, F.exists(F.sequence(x.low, x.high - 1), lambda i: test(F.get(spans, i)))).otherwise(False)
    searched = let(F.struct(low.alias("low"), high.alias("high")), found)
    return F.when(F.size(spans) > FEW, searched).otherwise(F.exists(spans, lambda s: (s.start < c.end) & (c.start < s.end) & test(s)))


def with_spans(docs: DataFrame, model: PiiModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`_row` (columns `keep`, or all, as a struct), `_text`, and arrays `_email`, `_ip`, `_card`, `_phone`, `_base` and `_spans` of (start, kind, end)."""
    rows = docs.select(packed(docs, docs.columns if keep is None else keep), text_of(text_col).alias("_text"))
    made = {f"_c{k}": c for k, c in enumerate(candidates_by_kind(F.col("_text")))}
    found = rows.select("_row", "_text", *[s.alias(f"_{k}") for k, s in base_spans(F.col("_text")).items()], *[c.alias(n) for n, c in made.items()])
    bases = [F.col(f"_{k}") for k in KINDS]
    taken = lambda c: reduce(or_, [meets(b, c, lambda _: F.lit(True)) for b in bases])
    shape = "array<struct<start:int,kind:int,end:int,p:double>>"

    def judged(own: Column, k: int) -> Column:
        free = F.filter(own, lambda c: ~taken(c))
        scored = F.transform(free, lambda c: F.struct(c.start.alias("start"), c.kind.alias("kind"), c.end.alias("end"), model.probability(c).alias("p")))
        return F.when(F.size(own) > 0, F.filter(scored, lambda c: c.p >= model.thresholds[k])).otherwise(F.array().cast(shape))

    found = found.withColumns({n: judged(F.col(n), k) for k, n in enumerate(made)})
    better = lambda o, c: (o.p > c.p) | ((o.p == c.p) & ((o.start < c.start) | ((o.start == c.start) & (o.kind < c.kind))))
    beaten = lambda c, k: reduce(or_, [meets(F.col(n), c, lambda o: better(o, c)) for i, n in enumerate(made) if i != k])
    added = [F.transform(F.filter(F.col(n), lambda c: ~beaten(c, k)), lambda c: F.struct(c.start.alias("start"), c.kind.alias("kind"), c.end.alias("end"))) for k, n in enumerate(made)]  # noqa: B023
    found = found.withColumn("_base", F.array_sort(F.concat(*bases)))
    return found.withColumn("_spans", F.array_sort(F.concat("_base", *added))).drop(*made)


def listed(spans: Column) -> Column:
    names = F.lit(list(KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")


def redacted(docs: DataFrame, model: PiiModel, text_col: str = "text") -> DataFrame:
    """`docs` with every span of the text replaced by its kind in brackets (overlapping spans by the first one's); null stays null."""
    rows = with_spans(docs, model, text_col)
    names = F.lit([f"[{k.upper()}]" for k in KINDS])

    def step(at: Column, s: Column) -> tuple[Column, Column]:
        """Of spans in order: how far the text is done, and what this one adds: the text from `low` to its start and its kind, or nothing."""
        piece = F.when(s.start >= at.at, F.struct(at.at.alias("low"), s.start.alias("high"), s.kind.alias("kind")))
        return F.struct(F.greatest(at.at, s.end).alias("at")), piece

    def rewritten(spans: Column) -> Column:
        pieces = F.array_compact(scanned(spans, F.struct(F.lit(0).alias("at")), step, "struct<low:int,high:int,kind:int>"))
        # four bytes a code point, so that each piece is cut out directly
        cut = lambda w, low, high: F.substring(w, low * 4 + 1, (high - low) * 4)
        kinds = F.transform(names, lambda n: F.encode(n, "UTF-32"))
        end = F.array_max(F.transform(spans, lambda s: s.end))
        parts = lambda w: F.concat(F.transform(pieces, lambda p: F.concat(F.hex(cut(w, p.low, p.high)), F.hex(F.get(kinds, p.kind)))), F.array(F.hex(F.substring(w, end * 4 + 1, F.octet_length(w)))))
        whole = lambda w: F.decode(F.concat(F.lit(b"\x00\x00\x00x"), F.unhex(F.array_join(parts(w), ""))), "UTF-32")  # noqa: E731  a letter in front, else U+FEFF would be lost
        return let(let(F.encode(F.col("_text"), "UTF-32"), whole), lambda t: F.substring(t, F.lit(2), F.length(t)))

    text = F.when(F.size("_spans") > 0, rewritten(F.col("_spans"))).otherwise(F.col("_row")[text_col])
    return rows.select(*[text.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns])
