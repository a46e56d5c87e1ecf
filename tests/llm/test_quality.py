"""The rule ensemble: statistics against a plain version, rules as columns, held-out accuracy, odd tables."""

import re
from collections import Counter
from itertools import groupby

import numpy as np
import pytest
from helpers import WORD, frame, odd_documents
from pyspark.sql import functions as F

MARKS = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def plain_statistics(text):
    from quantspark.llm.quality import STATISTICS
    words = WORD.findall(text or "")
    if not words:
        return dict.fromkeys(STATISTICS, 0.0)
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
    ink = "".join(words)
    lines = [x for x in (WORD.findall(line) for line in text.split("\n")) if x]
    # A repeated line has the same text from its first to its last word.
    spans = [re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\x0b\x0c\r")) for line in text.split("\n")
             if WORD.search(line)]
    letter = lambda c: c.isascii() and c.isalpha() or not c.isascii()
    letters = sum(map(letter, ink))
    triples = list(zip(low, low[1:], low[2:]))
    stops = [w[-1] in ".!?" for w in words]
    n, k = len(words), len(ink)
    data = text.encode()
    return {
        "words": n, "chars": len(text), "word_chars": k / n, "longest_word": max(map(len, words)),
        "letters": letters / k, "digits": sum(c in "0123456789" for c in ink) / k,
        "marks": sum(c in MARKS for c in ink) / k,
        "capitals": sum("A" <= c <= "Z" for c in ink) / letters if letters else 0,
        "non_ascii": sum(not c.isascii() for c in ink) / k,
        "marked_words": sum(len(w.encode()) > 2 and w[-1] in MARKS and w[-2] in MARKS for w in words) / n,
        "bare_marks": sum(all(c in MARKS for c in w) for w in words) / n, "distinct_words": len(set(low)) / n,
        "top_word": max(Counter(low).values()) / n, "word_again": sum(a == b for a, b in zip(low, low[1:])) / n,
        "distinct_triples": len(set(triples)) / len(triples) if triples else 0, "lines": len(lines),
        "repeated_lines": 1 - len(set(spans)) / len(lines), "line_words": n / len(lines),
        "sentence_words": n / sum(stops) if any(stops) else 0,
        "closed_lines": sum(line[-1][-1] in ".!?" for line in lines) / len(lines),
        "longest_run": max(len(list(g)) for _, g in groupby(data))}


def test_statistics_equal_a_plain_version(spark):
    from quantspark.llm.quality import text_statistics
    rows = odd_documents()
    rows += [(90 + i, t) for i, t in enumerate([
        "A B  A\tC\n\na b a c\nA B  A\tC\n", "!! ?? wow!! $$$ x", "7 77 7.5% é Ü中文 ...", "\n\n", "one", "Aa aA aa AA. b b",
        "zzzzzzzzzz", "x\ny\nx\ny.", "½ | a | b |"])]
    got = {(r["doc_id"], r["words"], r["chars"]): r.asDict() for r in text_statistics(frame(spark, rows)).collect()}
    for r in rows:
        want = plain_statistics(r[1])
        mine = got[(r[0], want["words"], want["chars"])]
        for name, value in want.items():
            assert mine[name] == pytest.approx(value, abs=1e-12), (r[0], name)


def test_rules_are_columns(spark):
    from quantspark.llm.quality import Rule, RuleEnsemble
    rows = [(float(a), float(b)) for a in range(4) for b in range(4)]
    model = RuleEnsemble((Rule((("words", 0.5, 2.5), ("lines", -np.inf, 1.0))), Rule((("lines", 2.0, np.inf),))),
                         (2.0, -3.0), 0.25)
    out = spark.createDataFrame(rows, "words double, lines double").withColumn("p", model.score()).collect()
    for r in out:
        z = 0.25 + 2 * (0.5 < r["words"] <= 2.5 and r["lines"] <= 1) - 3 * (r["lines"] > 2)
        assert r["p"] == pytest.approx(1 / (1 + np.exp(-z)))


def planted(n=240):
    """Documents of which every third is a list of marks, and their labels."""
    rows = odd_documents(n=n)
    docs, labels = [], []
    for k, r in enumerate(rows):
        bad = k % 3 == 0 and r[1] and len(r[1]) > 60
        docs.append((r[0], r[1].replace(" ", " | ") if bad else r[1], r[2]))
        if r[0] is not None:
            labels.append((r[0], 0 if bad else 1, 1, "x"))
    return docs, labels


def test_learns_and_holds_out(spark):
    from quantspark.llm.common import crc_mod
    from quantspark.llm.quality import score_quality, text_statistics, train_quality
    docs, labels = planted()
    labels += [(3, 1, 0, "x"), (3, 0, 0, "x"), (None, 0, 0, "x"), (4, None, 0, "x")]
    stats = text_statistics(frame(spark, docs))
    marked = spark.createDataFrame(labels, "doc_id long, quality int, words int, y string")
    model = train_quality(stats, marked, crc_mod(F.col("doc_id"), 5) != 0)
    assert model.rules and all(str(r) for r in model.rules)
    out = score_quality(stats, model).collect()
    assert len(out) == len(docs)
    truth = {r[0]: r[1] for r in labels if r[0] not in (None, 3, 4)}
    right = [r["predicted"] == truth[r["doc_id"]] for r in out if r["doc_id"] in truth]
    assert np.mean(right) >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)
    by_text = {}
    for r, d in zip(sorted(out, key=lambda r: repr(r["doc_id"])), sorted(docs, key=lambda d: repr(d[0]))):
        by_text.setdefault(d[1] or "", set()).add(r["score"]) if docs.count(d) == 1 else None
    assert all(len(s) == 1 for t, s in by_text.items() if not t)


def test_degenerate_tables(spark):
    from quantspark.llm.quality import score_quality, text_statistics, train_quality
    docs = frame(spark, odd_documents(n=8)).withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    stats = text_statistics(docs)
    for labels, want in (([], 0.5), ([("d1", 1)], 1.0), ([("d1", 0), ("d2", 0)], 0.0), ([("none", 0)], 0.5)):
        model = train_quality(stats, spark.createDataFrame(labels, "doc_id string, quality int"), F.lit(True))
        assert {round(r["score"], 9) for r in score_quality(stats, model).collect()} == {want}
    # Texts that no statistic tells apart: the score is the share of label 1.
    same = text_statistics(frame(spark, [(i, "a b") for i in range(8)]))
    model = train_quality(same, spark.createDataFrame([(i, int(i < 6)) for i in range(8)], "doc_id long, quality int"),
                          F.lit(True))
    assert {round(r["score"], 6) for r in score_quality(same, model).collect()} == {0.75}
    empty = text_statistics(frame(spark, []))
    assert score_quality(empty, train_quality(empty, spark.createDataFrame([], "doc_id long, quality int"),
                                              F.lit(True))).collect() == []


def test_given_table_held_out(spark):
    import __spark_entry__ as entry
    sf = "/root/testdata/sf0.01"
    out = entry.queries()["op11_quality"](spark, sf)
    assert out.count() == 1000
    held = out.filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    for y in (0, 1):
        own = [r["predicted"] == y for r in held if r["quality"] == y]
        assert np.mean(own) >= 0.9, (y, len(own))
