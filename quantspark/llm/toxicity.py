"""Toxicity by multiple-instance learning: sentences scored, combined by noisy-or, trained on document labels.

A document is toxic if any of its sentences is: p = 1 - (1 - p_0) prod(1 - p_s),
with a logistic score p_s per sentence that holds a feature and a p_0 per
document; sentences without a feature add nothing, so neutral text of any
length leaves the score where it is.  Only documents carry labels; the gradient of
the noisy-or assigns them to sentences, so the trained model also points at
the offending ones.  Features are the words of a sentence (lower case, outer
punctuation off) and their first 3 to 8 bytes, which catch inflected stems;
features tied to the label by a chi-squared test on the sample stay.

The classifier is fitted on at most ``MAX_PER_CLASS`` labelled rows per class,
whole texts of any length; the loss weighs them to the label counts of all
training rows.  Executors count the features and reduce each text to the sets
of tested features its sentences hold, so no text reaches the driver.  Scoring
reads every text whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantspark.llm import textvec as tv
from quantspark.llm.common import stored

MAX_PER_CLASS = 4000
PREFIXES = (3, 4, 5, 6, 7, 8)
MIN_DOCUMENTS = 4          # a feature must occur in so many sample documents
MIN_CHI2 = 15.0            # and be tied to the label: chi-squared of presence against label (p about 1e-4)
STEPS, RATE, L2 = 150, 0.1, 3e-5
THRESHOLD = 0.5
SCORE_BYTES = 1 << 19      # text scored at a time: its features take some 60 times as much
WEIGHT_FLOOR = 0.05        # smaller weights are not kept in the model

_WORD_BYTE = np.zeros(256, dtype=bool)
_WORD_BYTE[48:58] = _WORD_BYTE[65:91] = _WORD_BYTE[97:123] = True
_WORD_BYTE[128:] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[33, 46, 63]] = True


def sentence_features(buf: np.ndarray, offs: np.ndarray):
    """(feature hashes, sentence of each, document of each sentence, byte start and end of each sentence).

    A sentence ends with a word that ends in . ! ? or before a line break."""
    s, e, row = tv.word_spans(buf, offs)
    n = len(s)
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=np.uint64), z, z, z, z
    last = _STOP[buf[e - 1]].copy()
    inner = e < len(buf)
    last[inner] |= buf[e[inner]] == 10
    last[:-1] |= row[1:] != row[:-1]
    last[-1] = True
    sent = np.concatenate([[0], np.cumsum(last)[:-1]])
    close = np.flatnonzero(last)
    open_ = np.concatenate([[0], close[:-1] + 1])
    a, b = s.copy(), e.copy()
    while True:                                        # outer punctuation off
        cut = (a < b) & ~_WORD_BYTE[buf[np.minimum(a, len(buf) - 1)]]
        if not cut.any():
            break
        a[cut] += 1
    while True:
        cut = (a < b) & ~_WORD_BYTE[buf[np.maximum(b - 1, 0)]]
        if not cut.any():
            break
        b[cut] -= 1
    ok = a < b
    hashes, sents = [tv.span_hashes(buf, a[ok], b[ok])], [sent[ok]]
    for k in PREFIXES:
        longer = ok & (b - a > k)
        hashes.append(tv.mix(tv.span_hashes(buf, a[longer], a[longer] + k), k))
        sents.append(sent[longer])
    return np.concatenate(hashes), np.concatenate(sents), row[close], s[open_], e[close]


@dataclass
class NoisyOrModel:
    """Sorted feature hashes, their weights, the bias of a sentence with a feature and the logit of a document."""
    features: np.ndarray
    weights: np.ndarray
    bias: float
    base: float = -np.inf

    def sentence_scores(self, hashes: np.ndarray, sent: np.ndarray, n: int) -> np.ndarray:
        """Logit of every sentence; -inf without a feature."""
        z = np.full(n, -np.inf)
        if len(self.features):
            seen = np.zeros(1 << 18, dtype=bool)       # most words are no feature: one look rules them out
            mask = np.uint64((1 << 18) - 1)
            seen[self.features & mask] = True
            hit = np.flatnonzero(seen[hashes & mask])
            i = np.minimum(np.searchsorted(self.features, hashes[hit]), len(self.features) - 1)
            same = self.features[i] == hashes[hit]
            own = sent[hit][same]
            held = np.bincount(own, minlength=n) > 0
            z[held] = self.bias + np.bincount(own, weights=self.weights[i[same]], minlength=n)[held]
        return z


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _texts(batches):
    """(sentence_features, batch, first row, end row) of slices of documents, ``text`` being the last column."""
    for batch in batches:
        buf, offs = tv.arrow_text(batch.column(batch.num_columns - 1))
        for a, b in tv.slices(offs, 1 << 20):
            yield sentence_features(buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a]), batch, a, b


def tested_features(sample: DataFrame) -> np.ndarray:
    """Sorted hashes of the features of ``sample`` (doc_id, y, text) that the chi-squared test ties to y."""
    import pyarrow as pa

    def run(batches):
        for (h, s, d, _, _), batch, a, b in _texts(batches):
            toxic = batch.column(1).to_numpy(zero_copy_only=False)[a:b] > 0
            u, back = np.unique(h, return_inverse=True)
            pair = np.unique(back * np.int64(b - a) + d[s])      # a feature counts once a document
            word, bad = pair // (b - a), toxic[pair % (b - a)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(u.view(np.int64)), pa.array(np.bincount(word, minlength=len(u)).astype(np.int64)),
                 pa.array(np.bincount(word, bad, minlength=len(u)).astype(np.int64))],
                names=["feature", "present", "toxic"])

    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return np.zeros(0, dtype=np.uint64)
    n1, n = float(sizes[1]), float(sizes[0] + sizes[1])
    present, toxic = F.col("present").cast("double"), F.col("toxic").cast("double")
    spread = present * (F.lit(n) - present) * F.lit(n1 * (n - n1))
    chi2 = F.lit(n) * F.pow(toxic * F.lit(n) - present * F.lit(n1), F.lit(2.0)) / F.greatest(spread, F.lit(1.0))
    kept = (sample.mapInArrow(tv.released(run), "feature bigint, present bigint, toxic bigint").groupBy("feature")
            .agg(F.sum("present").alias("present"), F.sum("toxic").alias("toxic"))
            .filter((F.col("present") >= MIN_DOCUMENTS) & (chi2 >= MIN_CHI2)).select("feature").toArrow())
    return np.sort(kept["feature"].to_numpy().view(np.uint64))


def sentence_sets(sample: DataFrame, features: np.ndarray) -> DataFrame:
    """(doc_id, y, times, sizes, features) per document: how often each set of features makes a sentence (not the
    empty set), the sizes of these sets, and their members one set after the other as places in ``features``
    (int32 bytes)."""
    import pyarrow as pa

    def run(batches):
        for (h, s, d, _, _), batch, a, b in _texts(batches):
            i = np.minimum(np.searchsorted(features, h), len(features) - 1)
            hit = features[i] == h
            f, s = i[hit], s[hit]
            order = np.argsort(s, kind="stable")
            f, s = f[order], s[order]
            key = np.zeros(len(d), dtype=np.uint64)
            np.add.at(key, s, tv.mix(f) if len(f) else np.zeros(0, np.uint64))
            order = np.lexsort((key, d))
            new = np.ones(len(d), dtype=bool)
            new[1:] = (d[order][1:] != d[order][:-1]) | (key[order][1:] != key[order][:-1])
            at = np.flatnonzero(new)
            first = order[at]                                      # one sentence of each set
            times = np.diff(np.append(at, len(d)))
            lo = np.searchsorted(s, first)
            sizes = np.searchsorted(s, first, "right") - lo
            some = sizes > 0
            first, times, lo, sizes = first[some], times[some], lo[some], sizes[some]
            ends = np.cumsum(sizes)
            member = f[np.repeat(lo - (ends - sizes), sizes) + np.arange(sizes.sum())]
            cut = np.searchsorted(d[first], np.arange(b - a + 1))
            edge = np.append(0, ends)[cut]
            out = [[x[lo:hi].astype(np.int32).tobytes() for lo, hi in zip(k[:-1], k[1:])]
                   for x, k in ((times, cut), (sizes, cut), (member, edge))]
            rows = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), *[pa.array(x, pa.binary()) for x in out]],
                names=["doc_id", "y", "times", "sizes", "features"])

    return sample.mapInArrow(tv.released(run), f"doc_id {dict(sample.dtypes)['doc_id']}, y int, times binary, sizes binary, "
                                  "features binary")


def fit_noisy_or(u: np.ndarray, sets, labels: np.ndarray, class_weights=(1.0, 1.0)) -> NoisyOrModel:
    """Full-batch Adam on the weighted negative log likelihood of the documents; ``sets`` holds the columns
    times, sizes and features of ``sentence_sets``."""
    times, sizes, f = (np.frombuffer(b"".join(sets[k].to_pylist()), dtype=np.int32)
                       for k in ("times", "sizes", "features"))
    at = len(sizes)
    s = np.repeat(np.arange(at, dtype=np.int32), sizes)
    doc = np.repeat(np.arange(len(labels)), [len(x) // 4 for x in sets["sizes"].to_pylist()])
    weight = np.where(labels > 0, class_weights[1], class_weights[0]).astype(float)
    weight /= weight.sum()
    w, bias, base = np.zeros(len(u)), -4.0, -4.0
    m, v = np.zeros(len(u) + 2), np.zeros(len(u) + 2)
    for t in range(1, STEPS + 1):
        z = bias + np.bincount(s, weights=w[f], minlength=at)
        total = _softplus(base) + np.bincount(doc, weights=times * _softplus(z), minlength=len(labels))
        slope = np.where(labels > 0, -1.0 / np.expm1(np.clip(total, 1e-9, 50)), 1.0) * weight
        g = times * _sigmoid(z) * slope[doc]
        grad = np.append(np.bincount(f, weights=g[s], minlength=len(u)) + L2 * w,
                         [g.sum(), _sigmoid(base) * slope.sum()])
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        move = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
        w, bias, base = w - move[:-2], bias - move[-2], base - move[-1]
    kept = np.abs(w) >= WEIGHT_FLOOR
    return NoisyOrModel(u[kept], w[kept], float(bias), float(base))


def train_toxicity(docs: DataFrame, labels: DataFrame, trains: Column, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic") -> NoisyOrModel:
    """Fit on a bounded sample of the labelled rows for which ``trains`` (a condition on the id) holds.

    Rows without a label, id or text do not train; an id with several labels counts as toxic if one of
    them is.  Without both classes, or a feature that passes the test, the model scores every text 0.
    """
    marked = (labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").alias("y")).dropna()
              .groupBy("doc_id").agg(F.max((F.col("y") > 0).cast("int")).alias("y")).filter(trains))
    counts = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    pick = F.xxhash64(F.lit("tox"), F.col("doc_id").cast("string"))
    sample = None
    for y in (0, 1):
        part = marked.filter(F.col("y") == y).orderBy(pick, "doc_id").limit(MAX_PER_CLASS)
        sample = part if sample is None else sample.unionByName(part)
    text = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # At most 2 * MAX_PER_CLASS rows of ids and labels are broadcast.
    rows = stored(text.join(F.broadcast(sample), "doc_id").filter(F.col("text").isNotNull())
                  .dropDuplicates(["doc_id"]).select("doc_id", "y", "text"))
    u = tested_features(rows)
    if not len(u):
        return NoisyOrModel(u, np.zeros(0), 0.0)
    sets = sentence_sets(rows, u).toArrow().sort_by("doc_id")
    y = sets["y"].to_numpy()
    weights = [counts.get(k, 0) / max(1, int((y == k).sum())) for k in (0, 1)]
    return fit_noisy_or(u, sets, y, weights)


def score_documents(docs: DataFrame, model: NoisyOrModel, id_col: str = "doc_id", text_col: str = "text",
                    keep_columns: bool = False) -> DataFrame:
    """(doc_id, score, predicted, sentences) of every row, or all columns of ``docs`` and those three.

    ``sentences`` are the (start, end, score) of sentences at or above the threshold, in code points; a
    document above it without such a sentence names its highest one that holds a feature.  Null and empty
    texts score 0.
    """
    import pyarrow as pa

    item = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    kept = docs if keep_columns else docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                                                 F.col(f"`{text_col}`").alias("text"))
    kept = kept.drop("score", "predicted", "sentences") if keep_columns else kept
    at = kept.columns.index(text_col if keep_columns else "text")

    def run(batches):
        for batch in batches:
            buf, offs = tv.arrow_text(batch.column(at))
            scores, found = [], []
            for a, b in tv.slices(offs, SCORE_BYTES):
                part = buf[offs[a]:offs[b]]
                h, s, d, lo, hi = sentence_features(part, offs[a:b + 1] - offs[a])
                z = model.sentence_scores(h, s, len(d))
                total = np.bincount(d, weights=_softplus(z), minlength=b - a)
                total[d] += _softplus(model.base)                  # once a document that has a sentence
                p = -np.expm1(-total)
                scores.append(np.clip(p, 0.0, 1.0))
                rows = [[] for _ in range(b - a)]
                ps = _sigmoid(z)
                pick = np.flatnonzero(ps >= THRESHOLD)
                for r in np.setdiff1d(np.flatnonzero(p >= THRESHOLD), d[pick]):
                    own = np.flatnonzero((d == r) & np.isfinite(z))
                    pick = np.append(pick, own[np.argmax(ps[own])]) if len(own) else pick
                starts = offs[a:b + 1] - offs[a]
                for i in np.sort(pick):
                    base = starts[d[i]]
                    lead = (part[base:hi[i]] & 0xC0) != 0x80       # code points before and inside the sentence
                    first = int(lead[:lo[i] - base].sum())
                    rows[d[i]].append({"start": first, "end": first + int(lead[lo[i] - base:].sum()),
                                       "score": float(ps[i])})
                found += rows
            p = np.concatenate(scores) if scores else np.zeros(0)
            extra = [pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32)), pa.array(found, item)]
            cols, names = list(batch.columns), list(batch.schema.names)
            if not keep_columns:
                cols, names = cols[:1], names[:1]
            yield pa.RecordBatch.from_arrays(cols + extra, names=names + ["score", "predicted", "sentences"])

    base = kept if keep_columns else kept.select("doc_id")
    schema = ", ".join(f"`{c}` {t}" for c, t in base.dtypes)
    return kept.mapInArrow(tv.released(run), schema + ", score double, predicted int, "
                                         "sentences array<struct<start:bigint,end:bigint,score:double>>")
