"""Small documents and plain brute-force versions for the tests of the training-data operators."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, _gone int, score double"


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def frame(spark, rows, schema=SCHEMA):
    """Documents from (doc_id, text[, source]) with extra columns whose names clash with the operators' own."""
    data = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", 1, 0.5) for r in rows]
    return spark.createDataFrame(data, schema)


def odd_documents(seed=3, n=40):
    """Null ids and texts, empty, blank, long and repeated rows, ties, several scripts."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    text = lambda k: " ".join(rng.choice(vocab) for _ in range(k)) + "."
    rows = [(i, text(rng.randint(20, 120)), f"s{i % 4}") for i in range(n)]
    rows += [(n, None, "s0"), (n + 1, "", "s1"), (n + 2, " \n\t ", None), (n + 3, text(3), None),
             (n + 4, text(6000), "s1"), (n + 5, rows[2][1], "s2"), (n + 6, rows[2][1], "s2"),
             (n + 7, "Äß 中文 é " + text(30), "ü"), (None, text(25), "s0"), rows[5], rows[5]]
    base = rows[7][1].split()
    for k in range(3):                               # near copies: one word of many exchanged
        near = list(base) * 2
        near[k * 9] = f"edit{k}"
        rows.append((n + 10 + k, " ".join(near), "s3"))
    return rows
