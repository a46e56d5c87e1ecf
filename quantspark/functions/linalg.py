"""Linear models from distributed moment sums (Gramians): OLS, ridge, lasso, elastic net.

One aggregation over the rows gives, per block, n, sum x, sum y, sum x x', sum x y,
sum y^2 (p x p numbers).  Blocks combine by addition; centring and z-scoring
(population std, 0 -> 1) happen on the p x p matrices; the solvers work in
standardised units exactly like a scaler + linear model pipeline:

* OLS: minimum-norm least squares (pseudo-inverse of the normal equations);
* ridge: (Z'Z + a I) b = Z'y;
* lasso / elastic net: coordinate descent on the covariance form of
  (1/2n)||y - Zb||^2 + a r |b|_1 + a (1-r)/2 |b|^2.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Moments:
    n: float
    sx: np.ndarray
    sy: float
    sxx: np.ndarray
    sxy: np.ndarray
    syy: float

    def __add__(self, o: "Moments") -> "Moments":
        return Moments(self.n + o.n, self.sx + o.sx, self.sy + o.sy, self.sxx + o.sxx, self.sxy + o.sxy,
                       self.syy + o.syy)


def block_moments(df: DataFrame, cols: list[str], label: str, block: str | None,
                  shift: dict[str, float] | None = None) -> dict:
    """{block value: Moments} of the shifted columns.

    Each task folds its Arrow batches into per-block partial sums with numpy
    (a p x p outer-product sum per batch); the partials are summed by Spark
    (``posexplode`` + grouped sum, map-side combined), and only the final
    blocks x (p^2 + 2p + 3) numbers reach the driver.
    """
    import pandas as pd
    shift = shift or {}
    p = len(cols)
    sx_shift = np.array([float(shift.get(c, 0.0)) for c in cols])
    sy_shift = float(shift.get(label, 0.0))
    sel = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)],
                    F.col(label).cast("double").alias("y"),
                    (F.col(block).cast("long") if block else F.lit(0).cast("long")).alias("b"))
    xcols = [f"x{i}" for i in range(p)]

    def partial(batches):
        acc = {}
        for pdf in batches:
            X = np.nan_to_num(pdf[xcols].to_numpy(dtype=float) - sx_shift)
            y = np.nan_to_num(pdf["y"].to_numpy(dtype=float) - sy_shift)
            bl = pdf["b"].to_numpy()
            for bv in np.unique(bl):
                mk = bl == bv
                Xb, yb = X[mk], y[mk]
                v = np.concatenate([[float(mk.sum()), yb.sum(), yb @ yb], Xb.sum(axis=0), Xb.T @ yb,
                                    (Xb.T @ Xb).ravel()])
                acc[int(bv)] = acc[int(bv)] + v if int(bv) in acc else v
        if acc:
            yield pd.DataFrame({"b": list(acc.keys()), "v": [v.tolist() for v in acc.values()]})

    parts = sel.mapInPandas(partial, "b long, v array<double>")
    tot = (parts.select("b", F.posexplode("v").alias("i", "x"))
                .groupBy("b", "i").agg(F.sum("x").alias("x")).collect())
    vecs = {}
    for r in tot:
        vecs.setdefault(r["b"], np.zeros(3 + 2 * p + p * p))[r["i"]] = r["x"]
    out = {}
    for bv, v in vecs.items():
        out[bv if block else None] = Moments(v[0], v[3:3 + p], v[1], v[3 + 2 * p:].reshape(p, p),
                                              v[3 + p:3 + 2 * p], v[2])
    return out


@dataclass
class LinearSolution:
    """Prediction = intercept + sum w_j x_j (raw units); ``beta`` in standardised units."""
    intercept: float
    w: np.ndarray
    beta: np.ndarray
    mean: np.ndarray
    std: np.ndarray

    def expr(self, cols: list[str]) -> Column:
        e = F.lit(float(self.intercept))
        for c, w in zip(cols, self.w):
            if w != 0.0:
                e = e + F.lit(float(w)) * F.col(c).cast("double")
        return e


def _standardise(m: Moments, shift_x: np.ndarray, shift_y: float, standardize: bool = True):
    n = m.n
    mu = m.sx / n
    ybar = m.sy / n
    cxx = m.sxx - n * np.outer(mu, mu)
    cxy = m.sxy - n * mu * ybar
    var = np.clip(np.diag(cxx) / n, 0.0, None)
    std = np.sqrt(var) if standardize else np.ones_like(var)
    std[std == 0] = 1.0
    zz = cxx / np.outer(std, std)
    zy = cxy / std
    return zz, zy, mu + shift_x, ybar + shift_y, std


def solve(m: Moments, model: str, cfg: dict, shift_x: np.ndarray, shift_y: float,
          tol: float = 1e-8, standardize: bool = True) -> LinearSolution:
    """Coefficients from moments; lasso and elastic net descend to the tolerance.  The objective falls in
    every sweep, so the descent ends; a sweep that no longer lowers it (round-off) ends it too."""
    zz, zy, mean, ybar, std = _standardise(m, shift_x, shift_y, standardize)
    n, p = m.n, len(zy)
    if model == "linear_regression":
        beta = np.linalg.lstsq(zz, zy, rcond=None)[0]
    elif model == "ridge":
        beta = np.linalg.solve(zz + float(cfg.get("alpha", 1.0)) * np.eye(p), zy)
    elif model in ("lasso", "elasticnet"):
        a = float(cfg.get("alpha", 1.0))
        r = 1.0 if model == "lasso" else float(cfg.get("l1_ratio", 0.5))
        G, c = zz / n, zy / n
        l1, l2 = a * r, a * (1 - r)
        beta = np.zeros(p)
        r = c.copy()  # c - G beta, kept up to date
        diag = np.diag(G).copy()
        cols = [j for j in range(p) if diag[j] + l2 > 0]
        lowest = float("inf")
        while True:
            delta = 0.0
            for j in cols:
                rho = r[j] + diag[j] * beta[j]
                new = (rho - l1 if rho > l1 else rho + l1 if rho < -l1 else 0.0) / (diag[j] + l2)
                d = new - beta[j]
                if d != 0.0:
                    r -= G[:, j] * d
                    beta[j] = new
                    delta = max(delta, abs(d))
            value = float(-0.5 * beta @ (c + r) + l1 * np.abs(beta).sum() + 0.5 * l2 * beta @ beta)
            if delta < tol * max(1.0, float(np.abs(beta).max())) or not value < lowest:  # relative change
                break
            lowest = value
    else:
        raise ValueError(model)
    w = beta / std
    return LinearSolution(float(ybar - w @ mean), w, beta, mean, std)


def total(blocks: dict, keys) -> "Moments | None":
    out = None
    for k in keys:
        if k in blocks:
            out = blocks[k] if out is None else out + blocks[k]
    return out


def block_abs_errors(df: DataFrame, cols: list[str], label: str, block: str,
                     weights: np.ndarray, intercepts: np.ndarray) -> dict:
    """{block: (n, sum |y - (b_m + x w_m)| for every model m)} in one Arrow-batched pass.

    ``weights`` is p x m (one column per linear model in raw units); each task
    scores its batches with one matrix product and keeps per-block sums.
    """
    import pandas as pd
    m = weights.shape[1]
    sel = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)],
                    F.col(label).cast("double").alias("y"), F.col(block).cast("long").alias("b"))
    xcols = [f"x{i}" for i in range(len(cols))]

    def partial(batches):
        acc = {}
        for pdf in batches:
            X = np.nan_to_num(pdf[xcols].to_numpy(dtype=float))
            err = np.abs(pdf["y"].to_numpy(dtype=float)[:, None] - (X @ weights + intercepts[None, :]))
            bl = pdf["b"].to_numpy()
            for bv in np.unique(bl):
                mk = bl == bv
                v = np.concatenate([[float(mk.sum())], err[mk].sum(axis=0)])
                acc[int(bv)] = acc[int(bv)] + v if int(bv) in acc else v
        if acc:
            yield pd.DataFrame({"b": list(acc.keys()), "v": [v.tolist() for v in acc.values()]})

    parts = sel.mapInPandas(partial, "b long, v array<double>")
    tot = (parts.select("b", F.posexplode("v").alias("i", "x"))
                .groupBy("b", "i").agg(F.sum("x").alias("x")).collect())
    out = {}
    for r in tot:
        out.setdefault(r["b"], np.zeros(m + 1))[r["i"]] = r["x"]
    return {b: (v[0], v[1:]) for b, v in out.items()}
