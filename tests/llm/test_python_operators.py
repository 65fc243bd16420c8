import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from tierloom.llm import decontamination, lm_scoring, pieces, sentencepiece_sampling, simhash

from .fixtures import SCHEMA, documents, frame

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def vocabulary():
    return sentencepiece_sampling.default_vocabulary()


def test_simhash_matches_brute_force(spark):
    rows = documents()
    fps = []
    for _, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sh = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fps[i] ^ fps[j]).bit_count() <= 3 and group[j] < group[i]:
                    group[i], changed = group[j], True
    least = {g: min((r[0] for r, h in zip(rows, group) if h == g and r[0] is not None), default=None) for g in group}
    want = Counter((r[0], f"{f:016x}", least[g]) for r, f, g in zip(rows, fps, group))
    got = simhash.near_duplicates(frame(spark)).withColumn("hex", simhash.hex_of(simhash.F.col("fp"))).select("doc_id", "hex", "component_id").collect()
    assert Counter(map(tuple, got)) == want
    assert len(set(group)) < len(rows) - 3


@pytest.mark.parametrize("cell", [2048, 50, 4])  # one level, two, three
def test_simhash_links_of_large_cells(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62)
    fps = {int(base)}
    while len(fps) < 300:
        fps.add(int(base) ^ sum(1 << int(b) for b in rng.choice(63, 4, replace=False)))
    fps |= {int(x) for x in rng.integers(0, 1 << 62, 200)}
    fps = sorted(fps)
    seen = {f: f for f in fps}
    for _ in range(20):
        for f in fps:
            seen[f] = min(seen[g] for g in fps if (f ^ g).bit_count() <= 3)
    got = dict(map(tuple, simhash.components(simhash.link_forest(spark.createDataFrame([(f,) for f in fps], "fp long"))).collect()))
    clusters = lambda d: {frozenset(k for k in d if d[k] == v) for v in set(d.values())}
    assert {c for c in clusters(seen) if len(c) > 1} == clusters(got)


def test_simhash_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_decontamination_matches_brute_force(spark):
    docs = documents()
    items = [(1, docs[7][1]), (2, "ta re"), (3, None), (4, "-- !"), (5, "so la ti do fa en un os ka lu pe"), (6, docs[9][1].upper()), (None, "ta"), (10, "so, la; ti do fa en un os ka lu"), (2, "ta re"), (7, docs[-1][1][30:400])]
    docs.append((200, "zz SO la ti-do fa en un os ka lu pe zz pe", "en", "s", 1))
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    want = Counter()
    for d, text, *_ in docs:
        w = split(text)
        hit, found = set(), set()
        for i, t in items:
            iw = split(t)
            n = min(10, len(iw))
            if i is None or not n:
                continue
            windows = {tuple(iw[a : a + n]) for a in range(len(iw) - n + 1)}
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in windows:
                    hit |= set(range(a, a + n))
                    found.add(str(i))
        want[d, len(w), len(hit), tuple(sorted(found))] += 1
    bench = spark.createDataFrame(items, "item_id long, text string")
    for windows in (10**6, 40):
        got = decontamination.contaminated(spark.createDataFrame(docs, SCHEMA), bench, windows=windows).collect()
        assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in got) == want
    none = decontamination.contaminated(spark.createDataFrame(docs, SCHEMA), bench.limit(0), carry=["doc_id", "text"]).collect()
    assert len(none) == len(docs) and not any(r.n_hit for r in none)
    assert decontamination.contaminated(frame(spark, []), bench).count() == 0
    named = spark.createDataFrame([(f"mmlu/{i}", t) for i, t in items if i is not None], "item_id string, text string")
    clash = spark.createDataFrame(docs, SCHEMA).withColumns({c: simhash.F.lit("mine") for c in ("items", "n_hit", "_body", "_text_key", "_more", "item")})
    for windows in (10**6, 40):
        got = decontamination.contaminated(clash, named, windows=windows, carry=clash.columns).collect()
        assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(sorted(int(x[5:]) for x in r["items"]))) for r in got) == Counter({(d, a, b, tuple(sorted(map(int, x)))): n for (d, a, b, x), n in want.items()})
        assert all(r._body == r._text_key == r._more == r.item == "mine" for r in got)


def test_one_long_item_is_cut_into_blocks(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in rng.integers(0, 400, 3000)]
    docs = [(1, "x " + " ".join(words[700:760]) + " y"), (2, " ".join(words[38:48])), (3, " ".join(words[50:59])), (4, "none of these")]
    bench = spark.createDataFrame([("a", " ".join(words)), ("b", "none of")], "item_id string, text string")
    for windows in (10**6, 40):
        got = {r.doc_id: (r.n_hit, list(r["items"])) for r in decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench, windows=windows).collect()}
        assert got == {1: (60, ["a"]), 2: (10, ["a"]), 3: (0, []), 4: (2, ["b"])}


def test_lattice_sums_all_segmentations(vocabulary):
    table = pieces.Table(vocabulary)
    strings = [b"\xffthe", b"\xffhello", "\xe9".encode(), b"\n", b"\xff" * 5, b"zq" * 40]
    starts = np.r_[0, np.cumsum([len(s) for s in strings])]
    lattice = pieces.Lattice(table, np.frombuffer(b"".join(strings), np.uint8), starts)
    total = []
    for s in strings:
        a = [0.0] + [-math.inf] * len(s)
        for e in range(1, len(s) + 1):
            for b in range(max(0, e - table.longest), e):
                if (i := table.of_bytes.get(s[b:e])) is not None:
                    a[e] = np.logaddexp(a[e], a[b] + vocabulary.logp[i])
        total.append(a[-1])
    assert np.allclose(lattice.log_marginal(), total)
    # expected uses cover every byte once
    uses = lattice.expected(np.ones(len(strings)), len(vocabulary.pieces))
    assert math.isclose(sum(u * len(vocabulary.pieces[i]) for i, u in enumerate(uses) if u), starts[-1], rel_tol=1e-9)


def test_sampling_follows_the_posterior(vocabulary):
    table = pieces.Table(vocabulary)
    n = 4000
    ids, per = sentencepiece_sampling.sample(table, [b"hello"] * n, np.arange(n))
    drawn = Counter(tuple(x) for x in np.split(ids, np.cumsum(per)[:-1]))
    word = b"\xffhello"
    z = pieces.Lattice(table, np.frombuffer(word, np.uint8), np.array([0, len(word)])).log_marginal()[0]
    for seg, times in drawn.most_common(5):
        p = math.exp(sum(vocabulary.logp[i] for i in seg) - z)
        assert abs(times / n - p) < 4 * math.sqrt(p / n) + 1e-3
    assert len(drawn) > 3


def test_encoding_is_lossless_and_reproducible(spark, vocabulary):
    docs = frame(spark).withColumn("ids", simhash.F.lit("clash"))
    coded = sentencepiece_sampling.encode(docs, vocabulary)
    back = sentencepiece_sampling.decode(coded, vocabulary).collect()
    assert len(back) == len(documents())
    for r in back:
        assert r.decoded == r.text and (r.ids is None) == (r.text is None)
    again = sentencepiece_sampling.encode(docs.repartition(3), vocabulary).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.text or "", r.source or "", tuple(r.ids or ()))
    assert sorted(map(key, again)) == sorted(map(key, back))
    assert sentencepiece_sampling.encode(frame(spark, []), vocabulary).count() == 0


def test_kept_lattices_change_no_draw(vocabulary):
    table, kept = pieces.Table(vocabulary), pieces.Draws()
    texts = [(t or "").encode() for _, t, *_ in documents()]
    whole = sentencepiece_sampling.sample(table, texts, np.arange(len(texts)))
    parts = [sentencepiece_sampling.sample(table, texts[a : a + 7], np.arange(a, min(a + 7, len(texts))), 0, kept) for a in range(0, len(texts), 7)]
    assert len(kept.end) > 10
    assert np.array_equal(whole[0], np.concatenate([p[0] for p in parts])) and np.array_equal(whole[1], np.concatenate([p[1] for p in parts]))
    other = sentencepiece_sampling.sample(table, texts, np.arange(len(texts)), seed=1)
    assert not np.array_equal(whole[0], other[0])


def plain_lattice(word, pieces_of, weight):
    """(log-probability of all segmentations, expected uses by piece), by recursion over prefixes and suffixes."""
    n = len(word)
    ahead, behind = [1.0] + [0.0] * n, [0.0] * n + [1.0]
    edges = [(a, b, word[a:b]) for a in range(n) for b in range(a + 1, n + 1) if word[a:b] in pieces_of]
    for a, b, p in sorted(edges, key=lambda e: e[1]):
        ahead[b] += ahead[a] * weight(p)
    for a, b, p in sorted(edges, key=lambda e: -e[0]):
        behind[a] += weight(p) * behind[b]
    uses = Counter()
    for a, b, p in edges:
        uses[p] += ahead[a] * weight(p) * behind[b] / ahead[n]
    return math.log(ahead[n]), uses


@pytest.fixture(scope="module")
def lm_model(vocabulary):
    """Counts, training size and the brute-force model of the small documents: one step of expectation maximisation, token by token."""
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    held = lambda d: zlib.crc32(str("" if d is None else d).encode()) % 5 == 1
    c = Counter()
    for d, t, *_ in SMALL:
        if not held(d):
            c.update([*split(t), ""])
    own = {p: math.exp(w) for p, w in zip(vocabulary.pieces, vocabulary.logp) if p is not None}
    lattice_bytes = lambda w: b"\xff" + w.encode()
    uses, ends = Counter(), c[""]
    for w, n in c.items():
        if w:
            for p, x in plain_lattice(lattice_bytes(w), own, own.get)[1].items():
                uses[p] += n * x
    total = sum(uses.values())
    end = (ends + 0.5) / (ends + total + 1)
    weight = {p: (1 - end) * (lm_scoring.ADAPT * uses[p] / total + (1 - lm_scoring.ADAPT) * w) for p, w in own.items()}
    z = {w: plain_lattice(lattice_bytes(w), weight, weight.get)[0] for d, t, *_ in SMALL for w in split(t)}
    return split, held, c, z, end, uses


#: Without the long run of one letter, whose plain recursion underflows.
SMALL = [r for r in documents() if r[0] != 104]


@pytest.mark.parametrize("head", [2, 100_000])
def test_lm_scores_match_brute_force(spark, vocabulary, lm_model, head):
    split, held, c, z, end, _ = lm_model
    n, v = sum(c.values()), len(c)
    m = max(sum(x == 1 for w, x in c.items() if w), 1) / n
    clash = frame(spark, SMALL).withColumns({k: simhash.F.lit("mine") for k in ("token", "n", "held_out", "row", "base", "score", "z")})
    got = lm_scoring.scores(clash, vocabulary, head=head).collect()
    want = Counter()
    for d, t, *_ in SMALL:
        w = [*split(t), ""]
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        score = (sum(z[x] for x in w[:-1]) + math.log(end)) / math.log(10)
        mixed = sum(math.log10((1 - m) * c[x] / n + m * math.exp(z[x])) for x in w[:-1]) + math.log10((1 - m) * c[""] / n)
        want[d, held(d), len(w), sum(c[x] > 0 for x in w), n, round(base, 5), round(score, 5), round(mixed, 5)] += 1
    assert Counter((*r[:5], round(r.base_score, 5), round(r.score, 5), round(r.mixed_score, 5)) for r in got) == want


def test_one_step_of_expectation_maximisation(spark, vocabulary, lm_model):
    _, _, c, _, _, uses = lm_model
    got = lm_scoring.expected_uses(spark.createDataFrame(list(c.items()), "token string, n long"), vocabulary)
    assert np.allclose(got, [uses.get(p, 0.0) if p is not None else 0.0 for p in vocabulary.pieces], rtol=1e-9, atol=1e-12)
    logp, end = lm_scoring.adapted(got, c[""], vocabulary)
    assert math.isclose(np.exp(logp[np.isfinite(logp)]).sum() + math.exp(end), 1.0, rel_tol=1e-9)


def test_long_runs_score_finitely(spark, vocabulary):
    got = lm_scoring.scores(frame(spark), vocabulary).collect()
    assert len(got) == len(documents()) and all(r.score < 0 and math.isfinite(r.score) and math.isfinite(r.mixed_score) for r in got)


def test_lm_scores_without_training_rows(spark, vocabulary):
    only_held = [r for r in documents() if zlib.crc32(str(r[0]).encode()) % 5 == 1][:3]
    got = lm_scoring.scores(frame(spark, only_held), vocabulary).collect()
    assert len(got) == 3 and all(math.isfinite(r.score) and r.train_tokens == 0 and r.n_known == 0 for r in got)
    assert lm_scoring.scores(frame(spark, []), vocabulary).count() == 0


def test_token_probabilities_are_a_distribution(vocabulary):
    """The lattice mass of all tokens up to a length stays below one."""
    table = pieces.Table(vocabulary)
    singles = [b"\xff" + bytes([b]) for b in range(0x21, 0x7F)]
    data = np.frombuffer(b"".join(singles), np.uint8)
    z = pieces.Lattice(table, data, np.arange(0, len(data) + 1, 2)).log_marginal()
    assert np.exp(z).sum() < 1


def test_hash_helper_is_standard():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
