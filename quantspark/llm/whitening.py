"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance matrix is never formed.  A block Q of ``3 * components``
directions is multiplied by it in distributed passes: every task centres its
rows, adds up X'(XQ), and Spark sums the tasks' parts, so the driver holds
dimensions x block numbers whatever the row count.  A scaled Chebyshev
recurrence over such passes damps the spectrum below the block; QR and
Rayleigh-Ritz give the next block, until the residuals of all components are
certified small and reach the rounding or no longer fall.

Vectors are integers, so counts, sums and deviations are exact; a row is
centred as (n x - S) / n, without cancellation.  The distinct vectors are
stored once, many in a row, and every pass reads that table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.llm.common import stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
BLOCK_FACTOR = 3           # directions iterated per component
DEGREE = 10                # passes of one filter
CERTIFIED = 1e-12          # every component's residual over the geometric mean of its and the largest eigenvalue
EXACT = 2e-14              # no further rounds below this residual
NO_VARIANCE = 1e-12        # eigenvalues up to this share of the largest are rounding
MAX_ROUNDS = 60
PACK_BYTES = 1 << 20       # vectors stored per row


def scaled_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows whose vector is neither null nor holds null or non-finite entries."""
    v = F.col("v")
    ok = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (rows.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
            .filter(ok & (F.size("v") > 0))
            .select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE) + F.lit(SHIFT)).alias("x")))


def _matrix(column) -> np.ndarray:
    """An array<bigint> column as rows x dimensions; all arrays must be equally long."""
    offs = column.offsets.to_numpy()
    size = np.diff(offs)
    if len(size) and (size != size[0]).any():
        raise ValueError("vectors differ in length")
    return column.values.to_numpy()[offs[0]:offs[-1]].reshape(len(size), -1)


def _packed(fit: DataFrame) -> DataFrame:
    """The distinct vectors, many in one binary value: (d, rows, x)."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                step = max(1, PACK_BYTES // (8 * x.shape[1]))
                parts = [x[i:i + step] for i in range(0, len(x), step)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.shape[1]] * len(parts), pa.int32()), pa.array([len(p) for p in parts], pa.int64()),
                     pa.array([p.tobytes() for p in parts], pa.binary())], names=["d", "rows", "x"])

    return stored(fit.mapInArrow(run, "d int, rows bigint, x binary"))


@dataclass
class FitList:
    """The distinct vectors: stored packs (x), dimensions, count and sums per dimension."""
    packs: DataFrame
    d: int
    n: int
    sums: np.ndarray


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exact."""
    if n * int(max(abs(int(x.max())), abs(int(x.min())))) >= 1 << 62:
        raise OverflowError("a vector component times the number of vectors leaves 64 bits")
    return n * x - sums


def _summed(packs: DataFrame, d: int, part, shape: tuple[int, int], dtype=np.float64) -> np.ndarray:
    """Sum of ``part`` (rows x d vectors -> array of ``shape``) over the fit list: each task adds its own up,
    Spark adds the tasks'.  Only ``shape`` numbers reach the driver."""
    import pyarrow as pa

    def run(batches):
        total = np.zeros(shape, dtype=dtype)
        for batch in batches:
            for value in batch.column(0):
                total += part(np.frombuffer(value.as_buffer(), dtype=np.int64).reshape(-1, d))
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(shape[0], dtype=np.int32)), pa.array(list(total))],
                                             names=["i", "v"])

    kind = "bigint" if dtype is np.int64 else "double"
    got = (packs.select("x").mapInArrow(run, f"i int, v array<{kind}>").groupBy("i")
           .agg(F.expr(f"array({', '.join(f'sum(v[{j}])' for j in range(shape[1]))})").alias("v")).collect())
    out = np.zeros(shape, dtype=dtype)
    for r in got:
        out[r["i"]] = r["v"]
    return out


def fit_list(vectors: DataFrame) -> FitList | None:
    """Each distinct ``x`` once, or None without a vector."""
    packs = _packed(vectors.select("x").distinct())
    size = packs.agg(F.min("d").alias("low"), F.max("d").alias("d"), F.sum("rows").alias("n")).first()
    if not size["n"]:
        return None
    if size["low"] != size["d"]:
        raise ValueError("vectors differ in length")
    sums = _summed(packs, size["d"], lambda x: x.sum(axis=0)[:, None], (size["d"], 1), np.int64)
    return FitList(packs, size["d"], size["n"], sums[:, 0])


@dataclass
class Whitening:
    """Unit eigenvectors (d x k) and eigenvalues of the covariance, its trace, the worst residual as certified,
    and the number of passes."""
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float
    passes: int


def principal_components(fit: FitList, components: int = COMPONENTS) -> Whitening:
    """The leading eigenpairs to double precision; directions without variance are left out."""
    d, n, sums = fit.d, fit.n, fit.sums
    block, k = min(d, BLOCK_FACTOR * components), min(d, components)
    passes = 0
    spread = np.zeros(d)

    def product(q: np.ndarray) -> np.ndarray:
        """Covariance times ``q``: one pass over the fit list."""
        nonlocal passes, spread
        passes += 1

        def part(x):
            c = deviations(x, n, sums) / n
            return np.column_stack([c.T @ (c @ q), (c * c).sum(axis=0)])

        got = _summed(fit.packs, d, part, (d, q.shape[1] + 1)) / n
        spread = got[:, -1]
        return got[:, :-1]

    q = np.linalg.qr(np.random.default_rng(7).standard_normal((d, block)))[0]
    last = np.inf
    for _ in range(MAX_ROUNDS):
        w = product(q)
        h = q.T @ w
        theta, u = np.linalg.eigh((h + h.T) / 2)
        theta, u = theta[::-1], u[:, ::-1]
        q, w = q @ u, w @ u
        if theta[0] <= 0:
            return Whitening(np.zeros((d, 0)), np.zeros(0), 0.0, 0.0, passes)
        some = theta[:k] > NO_VARIANCE * theta[0]
        off = np.linalg.norm(w[:, :k] - q[:, :k] * theta[:k], axis=0)[some]
        worst = float((off / np.sqrt(theta[0] * theta[:k][some])).max())
        if worst <= EXACT or (worst <= CERTIFIED and (block == d or worst > last / 2)):
            break
        last = worst
        q = np.linalg.qr(_filtered(product, q, w, theta))[0]
    else:
        raise ArithmeticError(f"no convergence: residual {worst:.1e} after {passes} passes")
    vectors = q[:, :k][:, some]
    top = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[top, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return Whitening(vectors, theta[:k][some], float(spread.sum()), worst, passes)


def _filtered(product, q: np.ndarray, w: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """A Chebyshev polynomial of the covariance, small on [0, smallest Ritz value], times ``q``; ``w`` is the
    covariance times ``q``.  The degree keeps the growth of the first direction over the unwanted ones
    below 1e10, so that QR can tell all of them."""
    cut = theta[-1]
    if cut <= 1e-14 * theta[0]:
        return w
    degree = int(min(DEGREE, np.log(1e10) / np.arccosh(2 * theta[0] / cut - 1 + 1e-9)))
    half = cut / 2
    sigma1 = sigma = half / (theta[0] - half)
    y = (w - half * q) * (sigma / half)
    for _ in range(1, degree):
        new = 1 / (2 / sigma1 - sigma)
        q, y = y, (product(y) - half * y) * (2 * new / half) - (sigma * new) * q
        sigma = new
    return y


def identity_error(fit: FitList, model: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    k, n, sums = len(model.values), fit.n, fit.sums
    to = model.vectors / np.sqrt(model.values)

    def part(x):
        w = deviations(x, n, sums) / n @ to
        return np.column_stack([w.T @ w, w.sum(axis=0)])

    got = _summed(fit.packs, fit.d, part, (k, k + 1)) / n
    return float(np.abs(got[:, :-1] - np.outer(got[:, -1], got[:, -1]) - np.eye(k)).max())


def whitened_rows(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                  components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every remaining row and component.

    Rows with a null vector, null or non-finite entries take no part, nor do
    empty vectors; repeated rows count once in the fit and are all returned.
    Components without variance are left out (a single distinct vector has
    none), so fewer than ``components`` may remain.  An empty table gives an
    empty result.  Vectors of different lengths, and numbers beyond 64 bits,
    are an error.
    """
    import pyarrow as pa

    vectors = scaled_vectors(rows, id_col, vector_col)
    kind = dict(vectors.dtypes)["vec_id"]
    schema = (f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    fit = fit_list(vectors)
    model = principal_components(fit, components) if fit else None
    k = len(model.values) if model else 0
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(fit, model)
    n, sums = fit.n, fit.sums
    to, share = model.vectors / np.sqrt(model.values), model.values / model.trace

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 2048):
                batch = whole.slice(lo, 2048)
                dev = deviations(_matrix(batch.column(1)), n, sums)
                if (dev.astype(float)**2).sum(axis=1).max() >= 9.2e18:
                    raise OverflowError("a deviation leaves 64 bits")
                m = len(dev)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                     pa.array(np.repeat((dev * dev).sum(axis=1), k)), pa.array(((dev / n) @ to).ravel()),
                     pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, schema)
