"""The Merkle manifest against a plain version with hashlib; odd rows, large trees, empty tables."""

import hashlib
import zlib

import pytest
from helpers import frame, odd_documents
from pyspark.sql import functions as F


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_levels(nodes):
    """All levels of nodes, leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + 8])) for i in range(0, len(last), 8)])
    return levels


def plain_climb(levels, at, cur):
    """(root from ``cur`` at place ``at``, all siblings)."""
    siblings = ""
    for level in levels[:-1]:
        run = level[at // 8 * 8:at // 8 * 8 + 8]
        s = at % 8
        siblings += "".join(run[:s] + run[s + 1:])
        cur = sha("".join(run[:s] + [cur] + run[s + 1:]))
        at //= 8
    return cur, siblings


def plain_manifest(rows):
    """Sorted rows of the contract from (doc_id, text, lang, source, n_chars)."""
    item = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = lambda t: None if t is None else t.translate({c: c + 32 for c in range(65, 91)})
    trees = {}
    for i, text, lang, source, n in rows:
        leaf = sha(item(i) + item(source) + item(lang) + item(n) + item(text))
        hit = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        new = sha(item(i) + item(source) + item(lang) + item(n) + item(lower(text) if hit else text))
        trees.setdefault(lang, []).append((i, leaf, new))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in order:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        built[lang] = plain_levels([r[1] for r in trees[lang]])
    top = plain_levels([built[lang][-1][0] for lang in order])
    out = []
    for t, lang in enumerate(order):
        for at, (i, leaf, new) in enumerate(trees[lang]):
            sub, below = plain_climb(built[lang], at, new)
            root, above = plain_climb(top, t, sub)
            out.append((i, leaf, built[lang][-1][0], top[-1][0], sha(below + above), root, root == top[-1][0]))
    return sorted(out, key=repr)


def spark_manifest(docs):
    from quantspark.llm.common import ascii_lower
    from quantspark.llm.merkle import merkle_manifest
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.when(hit, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    return sorted((tuple(r) for r in merkle_manifest(docs, {"text": lowered}).collect()), key=repr)


def test_states_equal_hashlib():
    import numpy as np

    from quantspark.llm import sha_state as s
    digests = np.random.default_rng(1).integers(0, 256, (40, 9, 32)).astype(np.uint8)
    state = s.start(40)
    for n in range(10):
        got = s.finish(state, np.full(40, n))
        for row, mine in zip(got, digests):
            assert row.tobytes().hex() == hashlib.sha256(b"".join(d.tobytes().hex().encode() for d in mine[:n])).hexdigest()
        if n < 9:
            state = s.absorb(state, digests[:, n])


@pytest.mark.parametrize("langs", [1, 3, 70])
def test_odd_documents(spark, langs):
    rows = [(i, f"Big {text}" if text else text, [None, "en", "é", "zh", "=", ""][k % 6] if langs == 3 else f"l{k % langs}", source, k if k % 5 else None)
            for k, (i, text, source) in enumerate(odd_documents(n=200))]
    rows += [(5, "Same ROW", "en", "s", 8)] * 3 + [(3, "UPPER", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("leaf", F.lit("x")).withColumn("tree", F.lit(1)).withColumn("_idx", F.lit(2))
    got = spark_manifest(docs)
    assert got == plain_manifest(rows)
    assert any(not r[6] for r in got) and any(r[6] for r in got)


def test_trees_above_one_block(spark):
    from quantspark.llm.merkle import BLOCK
    n = 2 * BLOCK + 9                                       # a last block with one full run and one single node
    rows = [(i, f"Text {i}", "en" if i % 7 else "de", "s", i) for i in range(n * 7 // 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert spark_manifest(docs.repartition(5)) == plain_manifest(rows)


def test_one_row_and_no_row(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    one = [(4, "Only ONE", None, None, None)]
    assert spark_manifest(spark.createDataFrame(one, schema)) == plain_manifest(one)
    assert spark_manifest(spark.createDataFrame([], schema)) == []


def test_text_ids_and_untouched_columns(spark):
    from quantspark.llm.merkle import merkle_manifest
    docs = frame(spark, odd_documents()).withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    out = merkle_manifest(docs).collect()
    assert len(out) == docs.count() and all(r["verified"] for r in out)
