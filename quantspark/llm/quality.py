"""Quality classifier as a sparse ensemble of rules over text statistics.

Every text is reduced once to a few statistics (lengths, character classes,
repetition, line and sentence shape).  A random forest on labelled rows
proposes conditions: each path from a root to a node is a conjunction of
thresholds.  A lasso logistic regression over the rules' truth values keeps the
few that matter; these become one Spark column expression, so scoring is a
projection of the statistics.  Labels, language, source and ids are no inputs.

The model is fitted on about ``MAX_PER_CLASS`` labelled rows per class, chosen
by a hash of the id and weighted back to the class counts; forest and
regression run on executors.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantspark.llm import textvec as tv
from quantspark.llm.common import stored

MAX_PER_CLASS = 20_000
TREES, DEPTH, BINS = 20, 3, 64
LASSO = 3e-4
THRESHOLD = 0.3

STATISTICS = ("words", "chars", "word_chars", "longest_word", "letters", "digits", "marks", "capitals", "non_ascii",
              "marked_words", "bare_marks", "distinct_words", "top_word", "word_again", "distinct_triples",
              "lines", "repeated_lines", "line_words", "sentence_words", "closed_lines", "longest_run")

_KIND = np.zeros(256, dtype=np.uint8)                     # 1 letter, 2 digit, 3 mark, 0 else (space, inner bytes)
_KIND[65:91] = _KIND[97:123] = 1
_KIND[48:58] = 2
_KIND[33:48] = _KIND[58:65] = _KIND[91:97] = _KIND[123:127] = 3
_KIND[0xC0:] = 1
_STOP = np.zeros(256, dtype=bool)
_STOP[[33, 46, 63]] = True


def _repeats(row: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, count of the most frequent one) of each row."""
    key = np.sort(tv.mix(value + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
                  | row.astype(np.uint64) << np.uint64(44))
    head = np.ones(len(key), dtype=bool)
    head[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(head)
    own = (key[at] >> np.uint64(44)).astype(np.int64)
    top = np.zeros(rows, dtype=np.int64)
    np.maximum.at(top, own, np.diff(np.append(at, len(key))))
    return np.bincount(own, minlength=rows), top


def statistics(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """rows x len(STATISTICS); shares are of words, lines or characters other than white space.  0 where
    there is nothing to count, all 0 without a word."""
    rows = len(offs) - 1
    out = np.zeros((rows, len(STATISTICS)))
    s, e, row = tv.word_spans(buf, offs)
    if not len(s):
        return out
    count = lambda at, w=None: np.bincount(at, w, minlength=rows).astype(float)
    put = lambda name, v: out.__setitem__((slice(None), STATISTICS.index(name)), v)
    words = count(row)
    share = lambda x, of: np.divide(x, of, out=np.zeros(rows), where=of > 0)
    lead = (buf & 0xC0) != 0x80                            # first bytes of code points
    before = np.concatenate([[0], np.cumsum(lead)])
    length = before[e] - before[s]
    ink = count(row, length)
    put("words", words)
    put("chars", before[offs[1:]] - before[offs[:-1]])
    put("word_chars", share(ink, words))
    longest = np.zeros(rows)
    np.maximum.at(longest, row, length)
    put("longest_word", longest)
    of_byte = np.repeat(np.arange(rows), np.diff(offs))
    kind = _KIND[buf]
    letters = count(of_byte[kind == 1])
    put("letters", share(letters, ink))
    put("digits", share(count(of_byte[kind == 2]), ink))
    put("marks", share(count(of_byte[kind == 3]), ink))
    put("capitals", share(count(of_byte[(buf >= 65) & (buf < 91)]), letters))
    put("non_ascii", share(count(of_byte[buf >= 0xC0]), ink))
    last, low = kind[e - 1] == 3, np.maximum(e - 2, s)
    put("marked_words", share(count(row[last & (kind[low] == 3) & (e - s > 2)]), words))
    inner = np.concatenate([[0], np.cumsum(kind == 3)])
    put("bare_marks", share(count(row[inner[e] - inner[s] == e - s]), words))
    hashes = tv.span_hashes(buf, s, e)
    distinct, top = _repeats(row, hashes, rows)
    put("distinct_words", share(distinct, words))
    put("top_word", share(top, words))
    again = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    put("word_again", share(count(row[1:][again]), words))
    same = np.flatnonzero(row[2:] == row[:-2]) if len(row) > 2 else np.zeros(0, dtype=np.int64)
    if len(same):
        three = hashes[same] + hashes[same + 1] * np.uint64(3) + hashes[same + 2] * np.uint64(7)
        put("distinct_triples", share(_repeats(row[same], three, rows)[0], count(row[same])))
    first = np.concatenate([[0], np.cumsum(buf == 10)])    # line breaks before a byte
    line = first[s] + row                                  # a text's end also ends its line
    head = np.ones(len(line), dtype=bool)
    head[1:] = line[1:] != line[:-1]
    begin = np.flatnonzero(head)
    end = np.append(begin[1:], len(line)) - 1
    lines = count(row[begin])
    put("lines", lines)
    put("line_words", share(words, lines))
    whole = tv.span_hashes(buf, s[begin], e[end])
    put("repeated_lines", 1 - share(_repeats(row[begin], whole, rows)[0], np.maximum(lines, 1)) - (lines == 0))
    stops = _STOP[buf[e - 1]]
    put("sentence_words", share(words, count(row[stops])))
    put("closed_lines", share(count(row[end][stops[end]]), lines))
    run = np.zeros(rows)
    edge = np.ones(len(buf), dtype=bool)
    edge[1:] = buf[1:] != buf[:-1]
    edge[offs[:-1][offs[:-1] < len(buf)]] = True
    at = np.flatnonzero(edge)
    np.maximum.at(run, of_byte[at], np.diff(np.append(at, len(buf))))
    put("longest_run", run)
    out[words == 0] = 0.0
    return out


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, every one of ``STATISTICS``) of each row's whole text; null and empty texts have zeros."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            buf, offs = tv.arrow_text(batch.column(1))
            for a, b in tv.slices(offs):
                found = statistics(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *map(pa.array, found.T.copy())],
                                                 names=["doc_id", *STATISTICS])

    kind = dict(docs.dtypes)[id_col]
    return (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} double" for c in STATISTICS)))


@dataclass(frozen=True)
class Rule:
    """A conjunction of low < statistic <= high; each statistic occurs once."""
    bounds: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        parts = []
        for name, low, high in self.bounds:
            parts += [F.col(name) > low] * bool(np.isfinite(low)) + [F.col(name) <= high] * bool(np.isfinite(high))
        return reduce(Column.__and__, parts)

    def __str__(self) -> str:
        return " and ".join(f"{low:g} < {name} <= {high:g}" for name, low, high in self.bounds)


@dataclass(frozen=True)
class RuleEnsemble:
    """Rules, their weights and the intercept of the log odds of label 1."""
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float

    def score(self) -> Column:
        """The score as an expression over the statistics."""
        z = F.lit(float(self.intercept))
        for rule, weight in zip(self.rules, self.weights):
            z = z + F.when(rule.column(), F.lit(float(weight))).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def tree_rules(forest) -> list[Rule]:
    """The path to every node of a fitted forest's trees, each rule once."""
    found: dict[Rule, None] = {}

    def walk(node, bounds: dict):
        if bounds:
            found[Rule(tuple((STATISTICS[f], *bounds[f]) for f in sorted(bounds)))] = None
        if node.subtreeDepth():
            f, cut = node.split().featureIndex(), node.split().threshold()
            low, high = bounds.get(f, (-np.inf, np.inf))
            walk(node.leftChild(), bounds | {f: (low, min(high, cut))})
            walk(node.rightChild(), bounds | {f: (max(low, cut), high)})

    for tree in forest.trees:
        walk(tree._java_obj.rootNode(), {})
    return list(found)


def train_quality(stats: DataFrame, labels: DataFrame, trains: Column, id_col: str = "doc_id",
                  label_col: str = "quality") -> RuleEnsemble:
    """Fit on labelled rows of ``stats`` for which ``trains`` (a condition on doc_id) holds.

    Ids without a label or with labels of both kinds do not train; every row of
    a repeated id does.  Where only one label occurs, it is every text's
    score; without labels the score is 0.5.
    """
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    y = (F.col(f"`{label_col}`") > 0).cast("double")
    marked = (labels.select(F.col(f"`{id_col}`").alias("doc_id"), y.alias("y")).dropna().groupBy("doc_id")
              .agg(F.min("y").alias("y"), F.max("y").alias("other")).filter("y = other").drop("other").filter(trains))
    rows = stored(stats.join(marked, "doc_id"))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        odds = {0.0: -40.0, 1.0: 40.0}
        return RuleEnsemble((), (), odds[next(iter(counts))] if counts else 0.0)
    keep = {k: min(1.0, MAX_PER_CLASS / n) for k, n in counts.items()}
    pick = F.pmod(F.xxhash64(F.lit("quality"), F.col("doc_id").cast("string")), F.lit(1 << 20)) / float(1 << 20)
    rate = F.when(F.col("y") > 0, F.lit(keep[1.0])).otherwise(F.lit(keep[0.0]))
    sample = rows.filter(pick < rate).withColumn("weight", 1 / rate)
    sample = stored(sample.withColumn("x", array_to_vector(F.array(*STATISTICS))))
    forest = RandomForestClassifier(featuresCol="x", labelCol="y", weightCol="weight", numTrees=TREES, maxDepth=DEPTH,
                                    maxBins=BINS, minInstancesPerNode=5, featureSubsetStrategy="0.5", seed=11).fit(sample)
    rules = tree_rules(forest)
    if not rules:
        share = counts[1.0] / (counts[0.0] + counts[1.0])
        return RuleEnsemble((), (), float(np.log(share / (1 - share))))
    truth = F.array(*[F.when(r.column(), F.lit(1.0)).otherwise(0.0) for r in rules])
    fitted = LogisticRegression(featuresCol="z", labelCol="y", weightCol="weight", elasticNetParam=1.0, regParam=LASSO,
                                maxIter=100).fit(stored(sample.select("y", "weight", array_to_vector(truth).alias("z"))))
    kept = [(r, float(w)) for r, w in zip(rules, fitted.coefficients.toArray()) if w != 0.0]
    return RuleEnsemble(tuple(r for r, _ in kept), tuple(w for _, w in kept), float(fitted.intercept))


def score_quality(stats: DataFrame, model: RuleEnsemble) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``stats``."""
    return stats.select("doc_id", model.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
