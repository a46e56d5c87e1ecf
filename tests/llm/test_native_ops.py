"""Mixing, sharding and I-Match against plain versions; odd rows and empty tables."""

import hashlib
import math
import random
import zlib

import pytest
from helpers import frame, odd_documents, words
from pyspark.sql import functions as F


def fill(sizes, weights, cap=3):
    """Targets by sharing the excess again and again."""
    target, capped, total = {}, set(), sum(sizes.values())
    while True:
        free = [s for s in sizes if s not in capped]
        rest = total - sum(cap * sizes[s] for s in capped)
        wsum = sum(weights[s] for s in free)
        target = {s: cap * sizes[s] if s in capped else rest * weights[s] / wsum for s in sizes}
        over = {s for s in free if target[s] > cap * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mix_targets_and_cuts(spark):
    from quantspark.llm.mixing import mix_sources
    rows = odd_documents()
    out = mix_sources(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + len(words(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = fill(sizes, {s: i % 3 + 1 for i, s in enumerate(order)})
    for s in order:
        own = [r for r in out if r["source"] == s]
        assert own[0]["source_size"] == sizes[s]
        assert own[0]["target"] == pytest.approx(want[s])
        assert sum(r["taken"] for r in own) == math.floor(want[s] + 0.5)
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in own)
        partial = [r for r in own if r["size"] and r["taken"] % r["size"]]
        assert len(partial) <= 1
    again = mix_sources(frame(spark, rows).repartition(7)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["taken"])
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_mix_empty_and_wordless(spark):
    from quantspark.llm.mixing import mix_sources, mixed_documents
    assert mix_sources(frame(spark, [])).count() == 0
    out = mix_sources(frame(spark, [(1, None, None), (2, "", "a")])).collect()
    assert [r["taken"] for r in out] == [0, 0]
    docs = frame(spark, odd_documents())
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.groupBy("doc_id", "text").count().agg(F.max("count")).first()[0] <= 9   # 3 epochs, 3 equal rows


@pytest.mark.parametrize("n", [1, 2, 3, 39, 40, 41, 1000, 1023, 4097])
def test_permutation_is_a_bijection_with_inverse(spark, n):
    from quantspark.llm.sharding import grid, permuted
    a, b = grid(n)
    assert 0 <= a * b - n < a
    ids = spark.range(n).withColumn("p", permuted(F.col("id"), n)).withColumn("q", permuted(F.col("p"), n, inverse=True))
    rows = ids.collect()
    assert sorted(r["p"] for r in rows) == list(range(n))
    assert all(r["q"] == r["id"] for r in rows)


def test_shards(spark):
    from quantspark.llm.sharding import row_number_at, shard_documents
    rows = odd_documents()
    out = shard_documents(frame(spark, rows))
    got = out.collect()
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    counts = [len(by.get(s, [])) for s in range(40)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    want = sorted((r[0] is None, r[0] or 0, len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == want
    back = out.withColumn("back", row_number_at(F.col("shard"), F.col("slot"), len(rows)))
    assert back.filter("back != row_number").count() == 0
    assert shard_documents(frame(spark, [])).count() == 0


def test_imatch(spark):
    from quantspark.llm.imatch import fingerprints
    rows = odd_documents()
    out = fingerprints(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]) + [r for r in rows if r[0] is None]
    text = {r[0]: r[1] or "" for r in rows}
    nxt = {a[0]: b[1] or "" for a, b in zip(order, order[1:] + order[:1])}
    for r in out:
        t = text[r["doc_id"]]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[r["doc_id"]][:half]
        assert r["n_chars"] == len(t)
        if r["doc_id"] != 5:                          # id 5 stands three times: its successor may be itself
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if r["fingerprint"] == r["edited_fingerprint"]:
            assert r["near_edited"] == 1
    prints = {}
    for r in out:
        prints.setdefault(text[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in prints.values())
    busy = [r for r in out if r["n_chars"] > 100]
    assert sum(r["near_edited"] for r in busy) > 3 * sum(r["near_next"] for r in busy)


def test_imatch_edges(spark):
    from quantspark.llm.imatch import fingerprints
    assert fingerprints(frame(spark, [])).count() == 0
    one = fingerprints(frame(spark, [(7, "alone here")])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"alonealone").hexdigest()
    nulls = fingerprints(frame(spark, [(None, None), (None, "a b")])).collect()
    assert len(nulls) == 2


def test_imatch_runs_of_sorted_pairs(spark):
    """Every subset's run is hashed by itself: the first term's hash, then each further one chained to it."""
    from quantspark.llm.imatch import _starts, _subset_hashes
    rng = random.Random(4)
    data = [(i, sorted((rng.randrange(6), rng.randrange(-9, 9)) for _ in range(i))) for i in (0, 1, 2, 7, 40)]
    df = spark.createDataFrame(data, "id int, pairs array<struct<s:int,h:bigint>>")
    pairs = F.col("pairs")
    got = {r["id"]: r["m"] for r in df.select("id", _subset_hashes(pairs, _starts(pairs)).alias("m")).collect()}
    for i, run in data:
        assert set(got[i]) == {s for s, _ in run}
        for s in got[i]:
            terms = [h for t, h in run if t == s]
            want = F.xxhash64(F.lit(terms[0]).cast("bigint"))
            for h in terms[1:]:
                want = F.xxhash64(want, F.lit(h).cast("bigint"))
            assert spark.range(1).select(want.alias("w")).first()["w"] == got[i][s]
