"""Small documents with the cases that every operator must define."""

import random

WORDS = "ta re mi so la ti do fa en un os ka lu pe zo".split()


def documents() -> list[tuple]:
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.choice([1, 2, 3, 9, 10, 40, 200]))), "en", f"src{i % 3}", 0) for i in range(60)]
    rows += [(100, None, None, None, None), (101, "", "en", "src0", 0), (102, " \n\t ", "en", "src0", 3), (103, "日本語 テスト ▁ x", "ja", "src1", 1), (104, "a" * 5000, "en", "s", 5000)]
    rows += [(105, "Été à la PLAGE\n\n  deux  espaces", "fr", "s", 1), (None, "no id here but some words", "en", "s", 1), (3, rows[3][1], "en", "s", 1), (106, rows[5][1], "en", "s", 1)]
    rows += [(107, " ".join(rng.choices(WORDS, k=20_000)), "en", "s", 1)]
    base = rng.choices(WORDS, k=400)
    for i in range(6):
        base[rng.randrange(400)] = rng.choice(WORDS)
        rows.append((110 + i, " ".join(base), "en", "s", 1))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)
