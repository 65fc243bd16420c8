import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from tierloom.llm import chat_format, pii, queries, sharding, winnowing

from .fixtures import documents, frame

MARKED = "\ufeff"  # a decoder may take it for a byte-order mark
TRICKY = ["\\### Assistant: </turn> ok", "\\0\\1\\2", "####</turn></turn>\n### user: x", "\\", "", "a</turn", "é😀" * 5 + "</turn>\n", MARKED + " abc", MARKED, "a" + MARKED]


def python_unformat(text):
    turns = []
    for piece in text.split("</turn>\n")[:-1]:
        role, body = piece[4:].split(": ", 1)
        for by, what in (("\\3", ": "), ("\\2", "</turn>"), ("\\1", "###"), ("\\0", "\\")):
            role = role.replace(by, what)
            body = body.replace(by, what) if by != "\\3" else body
        turns.append((role, body))
    return turns


def test_chat_round_trip(spark):
    rows = []
    for c in range(6):
        for t in range(c + 1):
            rows.append((c, t, ["system", "user", "assistant"][t % 3], TRICKY[(c + t) % len(TRICKY)]))
    rows += [(10, 0, "user", None), (10, 1, None, "x"), (None, 0, "assistant", "no id"), (11, 0, "a: b", "odd role"), (12, 1, "assistant", "same"), (12, 1, "assistant", "same"), (13, 0, "assistant", "y" * 300_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat_format.formatted(chat_format.canonical_turns(df, F.col("conv_id")))
    got = made.select("*", chat_format.parsed(F.col("formatted")).alias("p"), chat_format.masked(F.col("formatted"), F.col("loss")).alias("m")).collect()
    want = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1], r[2] or "", r[3] or "")):
        want[c].append((r or "", x or ""))
    assert {g.conv_id: [tuple(x) for x in g.p] for g in got} == dict(want)
    for g in got:
        assert python_unformat(g.formatted) == want[g.conv_id]
        assert g.m == [x for r, x in want[g.conv_id] if r == "assistant"]
    assert chat_format.formatted(chat_format.canonical_turns(df.limit(0), F.col("conv_id"))).count() == 0


def test_fingerprints_select_mappings(spark):
    schema = "id long, messages array<struct<role:string,content:string>>, system string, prompt string, completion string, instruction string, input string, output string, conversations array<struct<from:string,value:string>>, extra string"
    rows = [
        (1, [("user", "a"), ("assistant", None), None], "sys", None, None, None, None, None, None, "z"),
        (2, None, None, "p", "c", None, None, None, None, None),
        (3, None, None, None, None, "do", "with", "done", None, None),
        (4, None, None, None, None, "do", None, "done", None, None),
        (5, None, None, None, None, None, None, None, [("human", "q"), ("gpt", "r")], None),
        (6, None, None, "p", None, None, None, "o", None, None),
        (7, None, None, None, None, None, None, None, None, None),
        (8, [], None, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    got = defaultdict(list)
    for r in chat_format.canonical_turns(df, F.col("id")).orderBy("conv_id", "turn").collect():
        got[r.conv_id].append((r.role, r.text))
    assert got == {
        1: [("system", "sys"), ("user", "a"), ("assistant", "")],
        2: [("user", "p"), ("assistant", "c")],
        3: [("user", "do\n\nwith"), ("assistant", "done")],
        4: [("user", "do"), ("assistant", "done")],
        5: [("user", "q"), ("assistant", "r")],
    }
    assert sorted(r.id for r in chat_format.unmatched(df).collect()) == [6, 7]
    assert {r.layout: r.rows for r in chat_format.layout_counts(df).collect()} == {"messages": 2, "prompt_completion": 1, "instruction": 2, "from_value": 1, "unmatched": 2}


def test_other_columns_do_not_hide_a_layout(spark):
    """Keys, dates and texts beside the messages, named as in turn rows or as working columns, change nothing."""
    turns = lambda df: {(r.conv_id, r.turn, r.role, r.text) for r in chat_format.canonical_turns(df, F.col("conv_id")).collect()}
    df = spark.createDataFrame([(1, 5, [("human", "q"), ("assistant", "a")]), (2, None, [("user", None)])], "conv_id long, turn long, messages array<struct<role:string,content:string>>")
    df = df.withColumns({"_layout": F.lit("mine"), "_conv": F.lit("mine"), "text": F.lit("caption")})
    assert turns(df) == {(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "user", "")}
    pairs = spark.createDataFrame([(1, "title", "p", "c"), (2, "title", None, None)], "conv_id long, text string, prompt string, completion string")
    assert turns(pairs) == {(1, 0, "user", "p"), (1, 1, "assistant", "c")} and chat_format.unmatched(pairs).count() == 1
    mixed = spark.createDataFrame([(1, 0, "human", "hi", None), (1, 1, "gpt", None, None), (2, None, None, None, [("q", "x")]), (3, None, None, None, None)], "conv_id long, turn long, role string, text string, conversations array<struct<from:string,value:string>>")
    assert turns(mixed) == {(1, 0, "user", "hi"), (1, 1, "assistant", ""), (2, 0, "q", "x"), (3, None, "", "")}
    made = chat_format.formatted(chat_format.canonical_turns(mixed, F.col("conv_id"))).where("conv_id = 1").first()
    assert len(made.loss) == 1 and made.formatted == "### user: hi</turn>\n### assistant: </turn>\n"
    assert chat_format.unmatched(mixed).count() == 0 and turns(mixed.limit(0)) == set()


def test_chat_query_reads_back(spark, tmp_path):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"t{c} {t}") for c in range(5) for t in range(4)] + [(9, 0, "assistant", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in queries.op1_chat_format(spark, str(tmp_path)).collect()}
    rows += [(-7, 0, "user", TRICKY[0]), (-7, 1, "assistant", TRICKY[0])]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, g in got.items():
        own = sorted(r for r in rows if r[0] == c)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert (g.n_turns, g.turns_sha256) == (len(own), sha("".join(f"{r[2]}\n{r[3] or ''}\n" for r in own)))
        assert (g.loss_chars, g.loss_sha256) == (len(loss), sha(loss))
    assert set(got) == {r[0] for r in rows}


@pytest.mark.parametrize("ranges", [192, 7])
def test_shards_match_a_plain_sort(spark, ranges, monkeypatch):
    monkeypatch.setattr(sharding, "SAMPLE", 4)
    rows = documents() + [(1000 + i, "hot copies of one text", "en", "s", 1) for i in range(400)] + [(5000 + i, "", "en", "s", 0) for i in range(300)]
    clash = frame(spark, rows).withColumns({c: F.lit("mine") for c in ("h", "i", "r", "n", "c", "shard", "at")})
    got = sharding.shards(clash, 8, ranges=ranges).collect()
    size = lambda t: len((t or "").encode()) + 1
    h = lambda t: int(hashlib.md5((t or "").encode()).hexdigest()[:15], 16)
    line = sorted((h(t), -(1 << 63) if d is None else d, d, size(t), zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    total = sum(x[3] for x in line)
    own, start, c = Counter(), {}, 0
    for k, _, _, s, _ in line:
        start.setdefault(k, c)
        own[k] += s
        c += s
    want, at, c = [], Counter(), 0
    for k, _, d, s, crc in line:
        middle = 2 * c + s if own[k] > 0.01 * total / 8 else 2 * start[k] + own[k]
        c += s
        shard = min(int(middle * 8 / (2 * total)), 7)
        want.append((d, s, crc, shard, at[shard]))
        at[shard] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got) == Counter(want)
    assert sharding.shards(frame(spark, []), 8).count() == 0
    assert sharding.shards(frame(spark, [(None, None, None, None, None)]), 8).count() == 1


def test_splitters_subdivide_overfull_ranges(spark):
    keys = spark.range(20_000).select(F.when(F.col("id") < 8000, 5).otherwise(F.xxhash64("id")).alias("h"), F.col("id").alias("i"), F.when(F.col("id") % 1000 == 0, 5000).otherwise(1).cast("long").alias("size"))
    cuts, held = sharding.splitters(keys, 32)
    assert sum(b for _, b, _ in held) == keys.agg(F.sum("size")).first()[0] and sum(n for *_, n in held) == 20_000
    assert max(n for *_, n in held) < 4 * 20_000 / 32


ALONE = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")


def python_tokens(text):
    """(start, token) by hand: runs without white space, single characters of scripts without spaces and of long runs."""
    out, at = [], 0
    for run in re.findall(r"[ \t\n\x0b\f\r]+|[^ \t\n\x0b\f\r]+", text):
        if run[0] not in " \t\n\x0b\f\r":
            part, begun = "", at
            for k, ch in enumerate([*run, None]):
                if ch is None or ALONE.match(ch):
                    if len(part) > winnowing.RUN:
                        out += [(begun + j, c) for j, c in enumerate(part)]
                    elif part:
                        out.append((begun, part))
                    if ch is not None:
                        out.append((at + k, ch))
                    part, begun = "", at + k + 1
                else:
                    part += ch
        at += len(run)
    return out


def python_winnow(text, gram=winnowing.GRAM, window=winnowing.WINDOW):
    tokens = python_tokens(text)
    if not tokens:
        return []
    mask = (1 << 64) - 1
    hs = [xxhash.xxh64_intdigest(t.lower().encode(), 42) for _, t in tokens]
    rot = lambda x, n: ((x << n) | (x >> (64 - n))) & mask if n else x
    g = []
    for i in range(max(1, len(hs) - gram + 1)):
        x = 0
        for h in hs[i : i + gram]:
            x = rot(x, 1) ^ h
        g.append(x >> 32)
    chosen = []
    for i in range(max(1, len(g) - window + 1)):
        best = min(enumerate(g[i : i + window], i), key=lambda x: (x[1], -x[0]))
        if best[0] not in [p for p, _ in chosen]:
            chosen.append(best)
    return [(h, tokens[p][0]) for p, h in chosen]


def test_winnowing_matches_brute_force(spark):
    rows = documents() + [(700, "la la la la la la la la la la", "x", "x", 1), (701, "ÀÉ日" * 60, "x", "x", 1), (702, " \n  Two  words", "x", "x", 1), (703, "b😀" * 40 + " short RUN日本x" + "Q" * 24 + " " + "q" * 25, "x", "x", 1)]
    rows += [(704, " ".join(f"w{i % 97}" for i in range(700)), "x", "x", 1), (704, "another text of the same id", "x", "x", 1), (704, "another text of the same id", "x", "x", 1), (705, "ไทย ภาษา 中文字符かなカナ한국어 말", "x", "x", 1)]
    clash = frame(spark, rows).withColumns({c: F.lit("mine") for c in ("_text", "_r", "_i", "_h", "_ghost", "_fp", "fingerprint", "size")})
    got = winnowing.compared(clash).collect()
    hashed = lambda t: int(np.array(xxhash.xxh64_intdigest(t.encode(), 42), np.uint64).view(np.int64))
    order = sorted(((-(1 << 63) if d is None else d), hashed(t or ""), t or "", d) for d, t, *_ in rows)
    by_key = defaultdict(list)
    for r in got:
        by_key[r.doc_id].append(r)
    seen = Counter()
    for k, (_, _, t, d) in enumerate(order):
        nxt = order[(k + 1) % len(order)][2]
        n = len(t) // 2
        edited = t[: len(t) - n] + nxt[:n]
        fp, fe, fn = python_winnow(t), python_winnow(edited), python_winnow(nxt)
        text = lambda f: ",".join(f"{h:x}@{p}" for h, p in f)
        like = lambda a, b: 1.0 if not a and not b else len({h for h, _ in a} & {h for h, _ in b}) / len({h for h, _ in a} | {h for h, _ in b})
        seen[(d, len(t), hashlib.sha256(edited.encode()).hexdigest(), text(fp), text(fe), round(like(fp, fe), 9), round(like(fp, fn), 9))] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == seen
    assert winnowing.compared(frame(spark, [])).count() == 0
    assert winnowing.compared(frame(spark, [(1, "one text alone", "", "", 1)])).count() == 1


def test_text_without_spaces_is_met_at_any_offset(spark):
    """A character in front, or another surrounding, changes no gram of a passage; positions say where it is in both texts."""
    rng = random.Random(5)
    chinese, blob = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(2000)), "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789+/", k=2000))
    texts = {}
    for k, t in enumerate((chinese, blob)):
        texts |= {(k, 0): t, (k, 1): "x" + t if k else "中" + t, (k, 2): "some words " + t[700:900] + ("zz" if k else "字")}
    rows = [(10 * k + j, t, "", "", 1) for (k, j), t in texts.items()]
    fp = {}
    for r in frame(spark, rows).select("doc_id", "text", winnowing.winnowed(F.col("text")).alias("w")).collect():
        fp[divmod(r.doc_id, 10)] = {x >> 31: ((1 << 31) - 1) - (x & ((1 << 31) - 1)) for x in r.w}
    for k in (0, 1):
        whole, shifted, part = fp[k, 0], fp[k, 1], fp[k, 2]
        both = set(whole) & set(shifted)
        assert len(both) / len(set(whole) | set(shifted)) > 0.98 and all(shifted[h] == whole[h] + 1 for h in both)
        met = [h for h in part if h in whole]
        assert len(met) > 50 and sum(whole[h] - 700 == part[h] - 11 for h in met) > 50


def test_shared_passages_share_a_hash(spark):
    passage = " ".join(f"w{i}" for i in range(winnowing.GRAM + winnowing.WINDOW - 1))
    rows = [(1, "left side " + passage + " and right", "", "", 1), (2, passage + " other end of it", "", "", 1)]
    a, b = frame(spark, rows).orderBy("doc_id").select(winnowing.hashes_of(winnowing.winnowed(F.col("text"))).alias("h")).collect()
    assert set(a.h) & set(b.h)


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def python_base(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
            if {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0, "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


PERSONAL = [
    "mail a@b.c_d@e.ff x@y.zz.", "a.b%c+d@e-f.gg.hh@i.j", "1.2.3.4.5.6.7.8 and 256.1.1.1 or 0000255.000.1.2", "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111111111",
    "+1 (640) 555-0953 +49 30 1234567890123 +123", "日本 a@b.co 😀 10.0.0.1 +1 555 123 4567", "9" * 20_000 + " a" * 100 + "a" * 20_000 + "@", "a@b.cc " * 1500, "x@y@z.com @@ a@b", "5500 0000 0000 0004+1 415 555 2671", "1.2.3", "", None,
]


def test_base_spans_match_the_plain_patterns(spark):
    rows = [(i, t, "", "", 0) for i, t in enumerate(PERSONAL)] + documents()
    model = pii.train(spark)
    got = pii.with_spans(frame(spark, rows), model).collect()
    assert Counter((r._row.doc_id, tuple(map(tuple, r._base))) for r in got) == Counter((d, tuple(python_base(t or ""))) for d, t, *_ in rows)
    assert all(set(map(tuple, r._base)) <= set(map(tuple, r._spans)) for r in got)
    assert pii.with_spans(frame(spark, []), model).count() == 0


def test_trees_add_spans_and_leave_decoys(spark):
    model = pii.train(spark)
    texts = {
        "contact jo.doe (at) example (dot) com now": [("email", "jo.doe (at) example (dot) com")],
        "please call me on 415-555-2671 today": [("phone", "415-555-2671")],
        "login from 10[.]0[.]0[.]7 seen": [("ip", "10[.]0[.]0[.]7")],
        "le +1 (826) 555-4081 190.137.223.204 du": [("phone", "+1 (826) 555-4081"), ("ip", "190.137.223.204")],  # the base pattern swallows both and drops them
        "order 415-555-2671 was sent": [],
        "the date is 2021-03-04 and page 12 34 56": [],
        "plain words without anything at all. next": [],
    }
    rows = [(i, t, "", "", 0) for i, t in enumerate(texts)]
    got = {r._text: [(pii.KINDS[s.kind], r._text[s.start : s.end]) for s in r._spans] for r in pii.with_spans(frame(spark, rows), model).collect()}
    assert got == texts


def test_thresholds_come_from_held_templates(spark):
    seen, held = {t for t, _ in pii.examples()}, {t for t, _ in pii.held_examples()}
    assert not seen & held
    report = pii.train(spark).report
    assert set(report) == set(pii.KINDS) and all(r["precision"] is None or r["precision"] >= pii.PRECISION for r in report.values())
    assert sum(r["recall"] > 0.5 for r in report.values()) >= 3


def test_many_spans_cost_no_square(spark):
    """50,000 spans in one text, base and added ones, all found, placed and redacted; overlaps found by search and by going through agree."""
    n = 12_500
    pieces = [f"call 415-555-{i % 10_000:04d} mail a{i}@b.co or jo at ex{i} dot com ip 10.0.{i % 256}.7" for i in range(n)]
    model = pii.train(spark)
    df = frame(spark, [(1, " ".join(pieces), "", "", 0), (2, pieces[0], "", "", 0)])
    got = {r._row.doc_id: r for r in pii.with_spans(df, model).collect()}
    assert len(got[2]._spans) == 4 and len(got[1]._spans) == 4 * n
    text, at = got[1]._text, 0
    for k, piece in enumerate(pieces[:200]):
        assert [(s.start - at, s.end - at) for s in got[1]._spans[4 * k : 4 * k + 4]] == [(5, 17), (23, 23 + len(f"a{k}@b.co")), (27 + len(f"a{k}@b.co"), 27 + len(f"a{k}@b.co") + len(f"jo at ex{k} dot com")), (len(piece) - len(f"10.0.{k % 256}.7"), len(piece))]
        at += len(piece) + 1
    assert text == " ".join(pieces)
    red = {r.doc_id: r.text for r in pii.redacted(df, model).collect()}
    assert red[1] == " ".join(["call [PHONE] mail [EMAIL] or [EMAIL] ip [IP]"] * n)


def test_redaction_replaces_spans(spark):
    model = pii.train(spark)
    rows = [(1, "a@b.co and +1 (640) 555-0953.", "", "", 0), (2, None, "", "", 0), (3, "clean text", "", "", 0), (4, "x +378282246310005 y", "", "", 0), (5, MARKED + "é😀 a@b.co" + MARKED, "", "", 0)]
    got = {r.doc_id: r.text for r in pii.redacted(frame(spark, rows), model).collect()}
    assert got[1] == "[EMAIL] and [PHONE]." and got[2] is None and got[3] == "clean text"
    assert got[4] == "x [PHONE] y"  # a card inside a phone number
    assert got[5] == MARKED + "é😀 [EMAIL]" + MARKED


def proposed(spark, texts):
    rows = frame(spark, [(i, t, "", "", 0) for i, t in enumerate(texts)]).select("text", pii.candidates(F.col("text")).alias("c")).collect()
    return {r.text: {(pii.KINDS[c.kind], c.match) for c in r.c} for r in rows}


def test_every_spelling_of_an_address_is_proposed(spark):
    """Whatever else the text holds; and every made sentence with personal data has a candidate or a base span."""
    forms = ["jo.doe" + at + "example" + dot + "com" for at in (" (at) ", "[at]", " at ", " (@) ") for dot in (" (dot) ", "[dot]", " dot ", ".")]
    got = proposed(spark, forms)
    assert all(("email", f) in got[f] for f in forms)
    good = [t for t, y in pii.examples() if y]
    assert all(proposed(spark, good).values())
    wanted = ["contact jo.doe at example[dot]com now", "write to jo.doe at example (dot) com now", "mail me: jo.doe at example.com now", "look at example.com now"]
    spans = {r._text: [r._text[s.start : s.end] for s in r._spans] for r in pii.with_spans(frame(spark, [(i, t, "", "", 0) for i, t in enumerate(wanted)]), pii.train(spark)).collect()}
    assert [spans[t] for t in wanted] == [["jo.doe at example[dot]com"], ["jo.doe at example (dot) com"], ["jo.doe at example.com"], []]


def test_numbers_of_any_grouping_are_proposed(spark):
    numbers = ["5551234567", "030 1234567", "0171 2345678", "030/1234567", "089/123456", "(555)123-4567", "+49 (0)30 1234567", "12 34 56"]
    got = proposed(spark, [f"tel {n} x" for n in numbers] + ["Tel.030/1234567", "12345678901234567890"])
    assert all(("phone", n) in got[f"tel {n} x"] for n in numbers) and ("phone", "030/1234567") in got["Tel.030/1234567"]
    assert not got["12345678901234567890"]
    texts = [f"please call tel {n} today" for n in numbers[:6]] + [f"order {n} was sent" for n in [*numbers[:6], "3.14159265358"]]
    spans = {r._text: [r._text[s.start : s.end] for s in r._spans] for r in pii.with_spans(frame(spark, [(i, t, "", "", 0) for i, t in enumerate(texts)]), pii.train(spark)).collect()}
    assert [spans[t] for t in texts] == [[n] for n in numbers[:6]] + [[]] * 7
