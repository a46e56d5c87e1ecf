"""Gradient boosting with leaf-wise trees on binned features, for squared error.

Features are binned once by quantiles and stored with the label in blocks of
``BLOCK_ROWS`` rows, the bins of a feature side by side, so that a pass reads
few large cells and no row of its own.  A tree grows best-first: of all leaves, the one whose best split gains most is split next,
until ``num_leaves`` or ``max_depth`` is reached.  The histograms (sum of
residuals and rows by leaf, feature and bin) of all leaves that may be split
next come from one pass: tasks add them up with numpy and Spark sums the
partial histograms, so the driver sees features x bins x leaves numbers
whatever the rows.  Splits are chosen again with each pass's figures, hence a
tree takes at most ``max_depth`` passes and equals the one grown leaf by leaf.

With G the sum of residuals and n the rows of a leaf, its value is
learning_rate * G / (n + l2), and a split gains G_l^2 / (n_l + l2) +
G_r^2 / (n_r + l2) - G^2 / (n + l2).  Rows are sampled per tree by a hash of
their values, features by the seed, so reruns agree on any partitioning.
"""

from __future__ import annotations

import heapq
import json
import math
import random
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.session import stored

MAX_BINS = 64                 # of a feature; at most 256 (a bin is one byte)
STORED_EVERY = 16             # trees after which predictions are stored with the rows
BLOCK_ROWS = 4096             # rows of a stored block
BLOCK_SCHEMA = "n int, x binary, y binary, pred binary, key binary"
LEAF = -1


class Tree:
    """Nodes as parallel arrays: feature (``LEAF`` for a leaf), bin and threshold (go left at or below), children,
    value of a leaf and gain of a split."""

    def __init__(self, feature, cut, threshold, left, right, value, gain):
        self.feature, self.cut, self.left, self.right = (np.array(v, dtype=np.int64) for v in (feature, cut, left, right))
        self.threshold, self.value, self.gain = (np.array(v, dtype=float) for v in (threshold, value, gain))

    def leaves(self, x: np.ndarray, bins: bool) -> np.ndarray:
        """The leaf of each row of ``x``, a matrix (rows by features) of bins or of feature values."""
        at, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        limit = self.cut if bins else self.threshold
        while (inner := self.feature[at] >= 0).any():
            i, f = at[inner], self.feature[at[inner]]
            at[inner] = np.where(x[rows[inner], f] <= limit[i], self.left[i], self.right[i])
        return at

    def predict(self, x: np.ndarray, bins: bool = False) -> np.ndarray:
        return self.value[self.leaves(x, bins)]

    def to_list(self) -> list:
        return [getattr(self, k).tolist() for k in ("feature", "cut", "threshold", "left", "right", "value", "gain")]


class Boosted:
    """A fitted ensemble: ``base`` plus the trees' values."""

    def __init__(self, base: float, trees: list[Tree], features: int):
        self.base, self.trees, self.features = base, trees, features

    def expr(self, cols: list[str]):
        """The prediction as a column (Arrow batches of the feature columns only)."""
        base, trees, p = self.base, self.trees, self.features

        @F.arrow_udf("double")
        def predict(x: pa.Array) -> pa.Array:
            m = _matrix(x, p)
            return pa.array(base + sum((t.predict(m) for t in trees), np.zeros(len(m))))

        return predict(F.array(*[F.col(c).cast("double") for c in cols]))

    def importance(self) -> np.ndarray:
        """Total gain by feature, sum 1."""
        out = np.zeros(self.features)
        for t in self.trees:
            inner = t.feature >= 0
            np.add.at(out, t.feature[inner], t.gain[inner])
        return out / out.sum() if out.sum() > 0 else out

    def to_json(self) -> str:
        return json.dumps({"base": self.base, "features": self.features, "trees": [t.to_list() for t in self.trees]})

    @staticmethod
    def from_json(text: str) -> "Boosted":
        d = json.loads(text)
        return Boosted(d["base"], [Tree(*t) for t in d["trees"]], d["features"])


def _matrix(cells: pa.Array, p: int) -> np.ndarray:
    """(rows by features) values of an Arrow column of arrays; a null is NaN."""
    return cells.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(-1, p)


def _blocks(batch: pa.RecordBatch, p: int):
    """(x rows by features, y, pred, key) of each stored block of a batch."""
    for n, x, *cells in zip(*(batch.column(i).to_pylist() for i in range(5))):
        y, pred, key = (np.frombuffer(c, dtype=t) for c, t in zip(cells, ("f8", "f8", "i8")))
        yield np.frombuffer(x, dtype=np.uint8).reshape(p, n).T, y, pred, key


def _block(x: np.ndarray, y: np.ndarray, pred: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    cells = [np.ascontiguousarray(v).tobytes() for v in (x.T, y, pred, key)]
    return pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int32()), *[pa.array([c], pa.binary()) for c in cells]],
                                      names=["n", "x", "y", "pred", "key"])


def _binned(df: DataFrame, cols: list[str], label: str, cuts: list[np.ndarray], base: float) -> DataFrame:
    """All rows in blocks (``BLOCK_SCHEMA``): bins, label, prediction and key; a missing value is in the last bin,
    right of every split."""
    p = len(cols)
    value = [F.col(c).cast("double") for c in cols]
    sel = df.select(F.array(*value).alias("v"), F.col(label).cast("double").alias("y"),
                    F.xxhash64(*value, F.col(label)).alias("key"))

    def block(held):
        x, y, key = (np.concatenate(v) for v in zip(*held))
        return _block(x, y, np.full(len(y), base), key)

    def run(batches):
        held, n = [], 0
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(at, BLOCK_ROWS)
                m = _matrix(part.column(0), p)
                x = np.empty((len(m), p), dtype=np.uint8, order="F")
                for j, c in enumerate(cuts):
                    x[:, j] = np.searchsorted(c, m[:, j])
                held.append((x, part.column(1).to_numpy(zero_copy_only=False), part.column(2).to_numpy()))
                n += len(m)
                if n >= BLOCK_ROWS:
                    yield block(held)
                    held, n = [], 0
        if held:
            yield block(held)

    return sel.mapInArrow(run, BLOCK_SCHEMA)


def _with_trees(rows: DataFrame, trees: list[Tree], p: int) -> DataFrame:
    """The rows with the trees' values added to their predictions."""
    def run(batches):
        for batch in batches:
            for x, y, pred, key in _blocks(batch, p):
                yield _block(x, y, pred + sum((t.predict(x, True) for t in trees), np.zeros(len(y))), key)

    return rows.mapInArrow(run, BLOCK_SCHEMA)


def _sampled(key: np.ndarray, tree: int, share: float) -> np.ndarray:
    """Whether each row takes part in a tree: a hash of its key and the tree's number."""
    if share >= 1:
        return np.ones(len(key), dtype=bool)
    h = key.astype(np.uint64) ^ np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % 2**64)
    for s, m in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(s))) * np.uint64(m)
    return (h ^ (h >> np.uint64(31))) < np.uint64(min(int(share * 2**64), 2**64 - 1))


def _histograms(rows: DataFrame, recent: list[Tree], partial: Tree, wanted: dict[int, int], feats: list[int], p: int,
                number: int, share: float) -> np.ndarray:
    """(wanted leaf, feature, bin, [sum of residuals, rows]) of the leaves ``wanted`` (leaf -> place) of a tree."""
    k, nf, B = len(wanted), len(feats), MAX_BINS
    place = np.full(len(partial.feature), -1)
    for leaf, at in wanted.items():
        place[leaf] = at

    def run(batches):
        acc = np.zeros((2, nf, k * B))
        for batch in batches:
            for x, y, pred, key in _blocks(batch, p):
                at = place[partial.leaves(x, True)]
                use = (at >= 0) & _sampled(key, number, share) & ~np.isnan(y)
                if not use.any():
                    continue
                if not use.all():
                    x, at, y, pred = np.asfortranarray(x[use]), at[use], y[use], pred[use]
                r = y - pred - sum((t.predict(x, True) for t in recent), np.zeros(len(x)))
                at = at * B
                for i, f in enumerate(feats):
                    cell = at + x[:, f]
                    acc[0, i] += np.bincount(cell, weights=r, minlength=k * B)
                    acc[1, i] += np.bincount(cell, minlength=k * B)
        full = np.flatnonzero(acc[1])
        yield pa.RecordBatch.from_arrays([pa.array(full), *[pa.array(a.ravel()[full]) for a in acc]], names=["i", "g", "n"])

    got = (rows.mapInArrow(run, "i long, g double, n double").groupBy("i")
           .agg(F.sum("g").alias("g"), F.sum("n").alias("n")).toArrow())      # at most leaves x features x bins rows
    out = np.zeros((nf * k * B, 2))
    out[got["i"].to_numpy()] = np.column_stack([got["g"].to_numpy(), got["n"].to_numpy()])
    return out.reshape(nf, k, B, 2).transpose(1, 0, 2, 3)


def _best_split(h: np.ndarray, feats: list[int], l2: float, least: int):
    """(gain, feature, bin, (G, n) left, (G, n) right) of the best split of one leaf, or None; ties go to the first
    feature and bin."""
    total = h[0].sum(axis=0)
    left = h.cumsum(axis=1)[:, :-1]
    right = total - left
    ok = (left[..., 1] >= least) & (right[..., 1] >= least)
    if not ok.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        score = left[..., 0]**2 / (left[..., 1] + l2) + right[..., 0]**2 / (right[..., 1] + l2)
    gain = np.where(ok, score - total[0]**2 / (total[1] + l2), -np.inf)
    i, b = np.unravel_index(int(gain.argmax()), gain.shape)
    return float(gain[i, b]), feats[i], int(b), tuple(left[i, b]), tuple(right[i, b])


def _grow(histograms, cuts, feats, total, num_leaves: int, max_depth: int, l2: float, least: int, rate: float) -> Tree:
    """One tree, best-first; ``histograms(partial tree, wanted leaves)`` is one pass over the rows."""
    splits: dict[int, tuple | None] = {}                     # best split of a node (heap numbering), once known
    sums = {0: total}                                        # (G, n) of a node

    def depth(node):
        return (node + 1).bit_length() - 1

    def may_split(node):
        return depth(node) < max_depth and sums[node][1] >= 2 * least

    while True:
        heap, chosen, open_, leaves = [], [], [], 1

        def offer(node):
            if may_split(node):
                if node not in splits:
                    open_.append(node)
                elif splits[node] and splits[node][0] > 1e-12 * (1 + abs(total[0])):
                    heapq.heappush(heap, (-splits[node][0], node))

        if num_leaves > 1:
            offer(0)
        while heap and leaves < num_leaves:
            _, node = heapq.heappop(heap)
            chosen.append(node)
            leaves += 1
            for child, part in ((2 * node + 1, 3), (2 * node + 2, 4)):
                sums[child] = splits[node][part]
                if leaves < num_leaves:
                    offer(child)
        index, columns = {0: 0}, [[] for _ in range(7)]
        for node in sorted({0, *chosen, *(c for n in chosen for c in (2 * n + 1, 2 * n + 2))}):
            index[node] = len(columns[0])
            s = splits[node] if node in chosen else None
            g, n = sums[node]
            row = ((s[1], s[2], float(cuts[s[1]][s[2]]) if s[2] < len(cuts[s[1]]) else math.inf, 2 * node + 1, 2 * node + 2,
                    0.0, s[0]) if s else (LEAF, 0, 0.0, 0, 0, rate * g / (n + l2) if n + l2 > 0 else 0.0, 0.0))
            for c, v in zip(columns, row):
                c.append(v)
        for c in (columns[3], columns[4]):
            c[:] = [index.get(v, 0) for v in c]
        tree = Tree(*columns)
        if not open_:
            return tree
        found = histograms(tree, {index[n]: i for i, n in enumerate(open_)})
        for i, node in enumerate(open_):
            splits[node] = _best_split(found[i], feats, l2, least)


@dataclass
class Binned:
    """Rows ready for boosting: their mean label, the cuts of every feature and the stored blocks (None where there is
    nothing to split).  Fits on the same rows, features and label may share it."""
    base: float
    cuts: list
    rows: DataFrame | None


def binned(df: DataFrame, cols: list[str], label: str) -> Binned:
    """Quantile cuts of every feature, and the rows binned by them and stored."""
    p = len(cols)
    probs = [i / MAX_BINS for i in range(1, MAX_BINS)]
    clean = df.filter(F.col(label).isNotNull())
    value = [F.when(~F.isnan(v), v) for v in (F.col(c).cast("double") for c in cols)]
    got = clean.agg(F.avg(F.col(label).cast("double")).alias("mean"), F.count(F.lit(1)).alias("n"),
                    *[F.percentile_approx(v, probs, 10_000).alias(f"q{j}") for j, v in enumerate(value)],
                    *[F.max(v).alias(f"m{j}") for j, v in enumerate(value)]).first()
    if not got["n"]:
        return Binned(0.0, [], None)
    cuts = [np.unique([q for q in got[f"q{j}"] or () if q < got[f"m{j}"]]) for j in range(p)]
    base = float(got["mean"])
    if not any(len(c) for c in cuts):
        return Binned(base, cuts, None)
    return Binned(base, cuts, stored(_binned(clean, cols, label, cuts, base), "boosting"))


def fit(df: DataFrame, cols: list[str], label: str, trees: int = 100, max_depth: int = 6, learning_rate: float = 0.1,
        num_leaves: int | None = None, l2: float = 1.0, subsample: float = 1.0, colsample: float = 1.0,
        min_rows: int = 1, seed: int = 42, ready: Binned | None = None) -> Boosted:
    """Boosted trees of ``label`` on ``cols``.

    Rows with a null label are left out; a null or NaN feature goes right at
    every split; without rows the model predicts 0.  ``ready`` holds the same
    rows as :func:`binned` made them, if several models are fitted on them.
    """
    p = len(cols)
    ready = ready or binned(df, cols, label)
    base, cuts, rows = ready.base, ready.cuts, ready.rows
    if rows is None:
        return Boosted(base, [], p)
    out, recent = [], []
    limit = num_leaves or 2**max_depth
    for number in range(trees):
        feats = sorted(random.Random(f"{seed} {number}").sample(range(p), max(1, math.ceil(colsample * p))))

        def histograms(partial, wanted):
            return _histograms(rows, recent, partial, wanted, feats, p, number, subsample)

        root = Tree([LEAF], [0], [0.0], [0], [0], [0.0], [0.0])
        first = histograms(root, {0: 0})
        held = {(0,): first}

        def passes(partial, wanted):
            return held.pop((0,)) if len(partial.feature) == 1 and (0,) in held else histograms(partial, wanted)

        tree = _grow(passes, cuts, feats, tuple(first[0, 0].sum(axis=0)), limit, max_depth, l2, min_rows, learning_rate)
        out.append(tree)
        recent.append(tree)
        if len(recent) >= STORED_EVERY:
            rows, recent = stored(_with_trees(rows, recent, p), "boosting"), []
    return Boosted(base, out, p)
