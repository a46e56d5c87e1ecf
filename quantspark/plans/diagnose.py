"""Feature, target and table diagnostics.

Per-feature statistics run as one long-format aggregation (feature x value
rows, partially aggregated before the shuffle).  Collinearity uses one
distributed Gramian of the complete-case rows; the p x p eigen/inverse work
is done on the driver.  ACF and PACF reduce lagged columns of a halo window to
41 sums; ADF multiplies blocks of the series lag by lag in one Arrow pass and
KPSS works on prefix sums, so their plans do not widen with the number of lags.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.functions.linalg import block_moments
from quantspark.functions.stats import corrected_kurt, corrected_skew
from quantspark.operators.ordered import halo_window, materialize, ranged, running_aggs, with_position

DIAG_EXCLUDE = {"trade_id", "timestamp", "pnl", "target", "strategy", "account_id", "trade_timestamp"}


def numeric_columns(df: DataFrame, exclude=DIAG_EXCLUDE) -> list[str]:
    from pyspark.sql import types as T
    num = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.ShortType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, num) and f.name not in exclude]


def _long(df: DataFrame, cols: list[str], keep=()) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])
    return df.select(*keep, F.explode(arr).alias("_f")).select(*keep, "_f.feature", "_f.v")


def feature_statistics(features: DataFrame, trades: DataFrame | None = None, cols: list[str] | None = None,
                       ts: str = "trade_timestamp") -> DataFrame:
    """M1 + M2 + M8 flags: one row per numeric feature."""
    cols = cols or numeric_columns(features)
    df = features
    if trades is not None and ts not in df.columns:
        df = df.join(trades.select(F.col("id").alias("trade_id"), F.col("timestamp").alias(ts)), "trade_id")
    lg = _long(df, cols, keep=[ts])
    v = F.col("v")
    inf = v.isin(float("inf"), float("-inf"))
    clean = F.when(~inf & ~F.isnan(v), v)
    a = lg.groupBy("feature").agg(
        F.count(F.lit(1)).alias("_rows"), F.count(clean).alias("_n"),
        F.avg(clean).alias("mean"), F.stddev_samp(clean).alias("_std"),
        F.min(clean).alias("min"), F.max(clean).alias("max"),
        F.skewness(clean).alias("_g1"), F.kurtosis(clean).alias("_g2"),
        F.count_if(v.isNull() | F.isnan(v)).alias("missing"), F.count_if(inf).alias("infinite"),
        F.min(F.when(v.isNotNull() & ~F.isnan(v), F.col(ts))).alias("first_appearance"),
        F.max(F.when(v.isNotNull() & ~F.isnan(v), F.col(ts))).alias("last_appearance"))
    n = F.col("_n")
    out = a.select(
        "feature", "mean", F.when(n > 1, F.col("_std")).alias("std"), "min", "max",
        F.when(n > 2, corrected_skew(F.col("_g1"), n)).alias("skewness"),
        F.when(n > 3, corrected_kurt(F.col("_g2"), n)).alias("kurtosis"),
        "missing", (F.col("missing") / F.col("_rows") * 100.0).alias("pct_missing"),
        "infinite", (F.col("infinite") / F.col("_rows") * 100.0).alias("pct_infinite"),
        F.when(F.col("min").isNull(), True).otherwise(F.col("min") == F.col("max")).alias("constant"),
        "first_appearance", "last_appearance")
    return out


def suspicious_features(stats: DataFrame, missing_pct: float = 10.0) -> DataFrame:
    """M8: constant, more than ``missing_pct`` % missing, or any infinite value."""
    reason = F.concat_ws(",", F.when(F.col("constant"), F.lit("constant")),
                         F.when(F.col("pct_missing") > missing_pct, F.lit("missing")),
                         F.when(F.col("infinite") > 0, F.lit("infinite")))
    return stats.select("feature", reason.alias("reasons")).filter(F.col("reasons") != "")


def _complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        x = F.col(c).cast("double")
        cond = cond & x.isNotNull() & ~F.isnan(x) & ~x.isin(float("inf"), float("-inf"))
    return df.filter(cond)


def collinearity(features: DataFrame, cols: list[str] | None = None, corr_threshold: float = 0.9):
    """M3-M7 from one Gramian of the complete-case rows.

    Returns (summary dict, correlation DataFrame (long), VIF DataFrame, high-pair DataFrame).
    """
    spark = features.sparkSession
    cols = cols or numeric_columns(features)
    cc = _complete_cases(features, cols).withColumn("_one", F.lit(0.0))
    shift_row = cc.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols],
                       *[(F.min(c) == F.max(c)).alias(f"_const_{i}") for i, c in enumerate(cols)]).first()
    shift = {c: (shift_row[c] or 0.0) if shift_row else 0.0 for c in cols}
    constant = np.array([bool(shift_row[f"_const_{i}"]) if shift_row else True for i in range(len(cols))])
    mom = block_moments(cc, cols, "_one", None, shift).get(None)
    p = len(cols)
    if mom is None or mom.n < 2:
        summary = {"rows": int(mom.n) if mom else 0, "condition_number": float("nan"), "rank": 0,
                   "features": p}
        empty = spark.createDataFrame([], "feature_a string, feature_b string, corr double")
        return summary, empty, spark.createDataFrame([], "feature string, vif double"), empty
    n = mom.n
    mu = mom.sx / n
    C = mom.sxx - n * np.outer(mu, mu)  # centred Gramian
    C[constant, :] = 0.0  # exactly constant columns (min == max): no round-off variance
    C[:, constant] = 0.0
    var_s = np.clip(np.diag(C) / (n - 1), 0.0, None)
    sd = np.sqrt(var_s)
    Zs = C / np.outer(sd + 1e-8, sd + 1e-8)  # M3: (x - mean) / (std + 1e-8)
    ev = np.clip(np.linalg.eigvalsh(Zs), 0.0, None)
    cond = float(math.sqrt(ev[-1] / ev[0])) if ev[0] > 0 else float("inf")
    K = np.array([shift[c] for c in cols])
    raw = mom.sxx + np.outer(K, mom.sx) + np.outer(mom.sx, K) + n * np.outer(K, K)  # uncentred X'X
    s = np.sqrt(np.clip(np.linalg.eigvalsh(raw), 0.0, None))
    rank = int((s > s.max() * max(n, p) * np.finfo(float).eps).sum()) if s.size else 0
    with np.errstate(divide="ignore", invalid="ignore"):
        corr = C / np.sqrt(np.outer(np.diag(C), np.diag(C)))
    corr[~np.isfinite(corr)] = np.nan
    rows = [(cols[i], cols[j], None if np.isnan(corr[i, j]) else float(corr[i, j]))
            for i in range(p) for j in range(p)]
    corr_df = spark.createDataFrame(rows, "feature_a string, feature_b string, corr double")
    high = [(cols[i], cols[j], float(corr[i, j])) for i in range(p) for j in range(i)
            if not np.isnan(corr[i, j]) and abs(corr[i, j]) > corr_threshold]
    high_df = spark.createDataFrame(high, "feature_a string, feature_b string, corr double")
    # VIF of every feature: the diagonal of one (pseudo-)inverse; constant features have none.
    ok = np.diag(C) > 0
    R = np.where(np.isnan(corr), 0.0, corr)
    d = iter(np.diag(np.linalg.pinv(R[np.ix_(ok, ok)])))
    vif_rows = [(c, float(next(d)) if ok[i] else float("inf")) for i, c in enumerate(cols)]
    vif_df = spark.createDataFrame(vif_rows, "feature string, vif double")
    summary = {"rows": int(n), "condition_number": cond, "rank": rank, "features": p,
               "rank_deficient": rank < p}
    return summary, corr_df, vif_df, high_df


def sanity(df: DataFrame, feature_cols: list[str], ts: str = "timestamp", target: str = "pnl") -> DataFrame:
    """M9: one row of violation counts (duplicate timestamps, infinite values, target variance)."""
    dup = (df.groupBy(ts).count().filter(F.col("count") > 1)
             .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("duplicate_timestamp_rows")))
    inf = F.lit(0)
    for c in feature_cols:
        inf = inf + F.when(F.col(c).cast("double").isin(float("inf"), float("-inf")), 1).otherwise(0)
    base = df.agg(F.sum(inf).alias("infinite_values"), F.var_samp(target).alias("target_variance"))
    out = base.join(dup, how="inner", on=F.lit(True))  # one-row frames
    return out.withColumn("passed", (F.col("duplicate_timestamp_rows") == 0) & (F.col("infinite_values") == 0)
                          & ~(F.col("target_variance") == 0))


def raise_if_unusable(df: DataFrame, feature_cols: list[str], target: str = "pnl") -> None:
    """M9 as a guard before training: infinite feature values or a target that is missing or does not vary."""
    inf = F.lit(0)
    for c in feature_cols:
        inf = inf + F.when(F.col(c).cast("double").isin(float("inf"), float("-inf")), 1).otherwise(0)
    r = df.agg(F.sum(inf).alias("inf"), F.var_samp(target).alias("var"),
               F.count_if(F.col(target).isNull() | F.isnan(target)).alias("missing")).first()
    if r["inf"] or r["missing"] or (r["var"] is not None and r["var"] == 0):
        raise ValueError(f"training data: {r['inf'] or 0} infinite feature values, {r['missing']} missing targets, "
                         f"target variance {r['var']}")


def prediction_sanity(predictions: DataFrame, pred: str = "predicted_pnl") -> DataFrame:
    """Collapsed predictions (all equal) and NaN metrics, one row."""
    return predictions.agg(F.min(pred).alias("_mn"), F.max(pred).alias("_mx"),
                           F.count_if(F.isnan(pred) | F.col(pred).isNull()).alias("invalid_predictions")).select(
        (F.col("_mn") == F.col("_mx")).alias("collapsed"), "invalid_predictions")


def check_importances(importances: DataFrame) -> DataFrame:
    """Per fold, all feature importances exactly zero."""
    return importances.groupBy("fold").agg((F.sum(F.abs("importance")) == 0).alias("all_zero"))


def check_params(params: dict) -> None:
    """Empty or null parameter sets are errors."""
    if not params:
        raise ValueError("a parameter set without entries cannot be trained")
    unset = [k for k, v in params.items() if v is None or v != v]
    if unset:
        raise ValueError(f"parameters without a value: {', '.join(map(str, unset))}")


def target_statistics(df: DataFrame, target: str = "pnl", min_rows: int = 10) -> DataFrame:
    """M11 + L24: distribution statistics of the target (one row; empty below ``min_rows``)."""
    a = df.filter(F.col(target).isNotNull()).agg(
        F.count(target).alias("n"), F.avg(target).alias("mean"), F.var_samp(target).alias("variance"),
        F.stddev_samp(target).alias("std"), F.skewness(target).alias("_g1"), F.kurtosis(target).alias("_g2"),
        F.stddev_pop(target).alias("_sp"))
    x = df.filter(F.col(target).isNotNull()).join(F.broadcast(a.select("mean", "_sp")), how="inner", on=F.lit(True))
    out_pct = x.agg((F.avg(F.when(F.abs((F.col(target) - F.col("mean")) / F.col("_sp")) > 3, 1.0).otherwise(0.0))
                     * 100.0).alias("outliers_pct"))
    jb = F.col("n") / 6.0 * (F.col("_g1") ** 2 + F.col("_g2") ** 2 / 4.0)
    return (a.join(out_pct, how="inner", on=F.lit(True)).filter(F.col("n") >= min_rows)
             .select("n", "mean", "variance", "std",
                     corrected_skew(F.col("_g1"), F.col("n")).alias("skewness"),
                     corrected_kurt(F.col("_g2"), F.col("n")).alias("kurtosis"),
                     F.when(F.col("std") != 0, F.col("mean") / F.col("std")).alias("snr"),
                     "outliers_pct", jb.alias("jb_statistic"), F.exp(-jb / 2.0).alias("jb_p_value")))


def _lag_sums(df: DataFrame, value: str, order, lags: int, center: float, block_rows: int) -> dict:
    """sum_t (x_t - c)(x_{t-k} - c) for k = 0..lags, plus n (one halo pass, one aggregate)."""
    x = df.select(*order, (F.col(value) - F.lit(center)).alias("_x"))
    h = halo_window(x, lags, lambda w: {f"_l{k}": F.lag("_x", k).over(w) for k in range(1, lags + 1)},
                    order=list(order), block_rows=block_rows)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(F.col("_x") * F.col("_x")).alias("s0")]
    aggs += [F.sum(F.col("_x") * F.col(f"_l{k}")).alias(f"s{k}") for k in range(1, lags + 1)]
    r = h.agg(*aggs).first()
    return {"n": r["n"], **{k: (r[f"s{k}"] or 0.0) for k in range(lags + 1)}}


def acf(df: DataFrame, value: str = "pnl", order=("timestamp", "trade_id"), lags: int = 40,
        block_rows: int = 1 << 16) -> DataFrame:
    """r_k = sum (x_t - m)(x_{t-k} - m) / sum (x - m)^2, k = 0..lags."""
    m = df.agg(F.avg(value)).first()[0]
    s = _lag_sums(df.filter(F.col(value).isNotNull()), value, order, lags, m or 0.0, block_rows)
    rows = [(k, (s[k] / s[0]) if s[0] else None) for k in range(lags + 1)]
    return df.sparkSession.createDataFrame(rows, "lag int, acf double")


def pacf_from_acf(r: list[float]) -> list[float]:
    """Durbin-Levinson recursion on autocorrelations r[0..K] (Yule-Walker)."""
    K = len(r) - 1
    out = [1.0]
    phi = []
    for k in range(1, K + 1):
        num = r[k] - sum(phi[j] * r[k - 1 - j] for j in range(k - 1))
        den = 1.0 - sum(phi[j] * r[j + 1] for j in range(k - 1))
        pkk = num / den if den else float("nan")
        phi = [phi[j] - pkk * phi[k - 2 - j] for j in range(k - 1)] + [pkk]
        out.append(pkk)
    return out


def pacf(df: DataFrame, value: str = "pnl", order=("timestamp", "trade_id"), lags: int = 40,
         block_rows: int = 1 << 16) -> DataFrame:
    a = acf(df, value, order, lags, block_rows).orderBy("lag").collect()  # lags + 1 numbers
    p = pacf_from_acf([x["acf"] for x in a])
    return df.sparkSession.createDataFrame([(k, float(v)) for k, v in enumerate(p)], "lag int, pacf double")


def _norm_cdf(z: float) -> float:
    return 0.5 * (1.0 + math.erf(z / math.sqrt(2.0)))


def adf_pvalue(tau: float) -> float:
    """MacKinnon (1994) approximate p-value, constant-only regression (published coefficients)."""
    if tau > 2.74:
        return 1.0
    if tau < -18.83:
        return 0.0
    if tau <= -1.61:
        return _norm_cdf(2.1659 + 1.4412 * tau + 0.038269 * tau ** 2)
    return _norm_cdf(1.7339 + 0.93202 * tau - 0.12745 * tau ** 2 - 0.010368 * tau ** 3)


@dataclass
class LagProducts:
    """Sums over a series y_0..y_{n-1} (shifted) with d_t = y_t - y_{t-1}: ``dd[k]`` = sum d_t d_{t-k},
    ``yd[j]`` = sum y_{t-1} d_{t-j}, ``y``, ``yy`` = sums of y_{t-1} and its square, ``d`` = sum d_t, all over
    t up to n - 1; and the values at both ends of the series."""
    n: int
    dd: np.ndarray
    yd: np.ndarray
    y: float
    yy: float
    d: float
    head: np.ndarray
    tail: np.ndarray

    def gramian(self, lag: int, start: int) -> tuple[np.ndarray, np.ndarray, float, int]:
        """(X'X, X'y, y'y, rows) of d_t on 1, y_{t-1}, d_{t-1}..d_{t-lag} over t = start..n-1.

        The products of the whole series lose the rows before ``start`` and, where
        both factors are lagged, those that the shift moves past the end.
        """
        n, m = self.n, lag + 1
        base = n - len(self.tail)                          # tail holds y_base..y_{n-1}
        dh = np.append(0.0, np.diff(self.head))            # dh[u] = d_u
        dt = np.append(0.0, np.diff(self.tail))            # dt[u - base] = d_u
        out = np.zeros((m, m))
        for k in range(m):
            early = np.append(np.zeros(k + 1), dh[k + 1:] * dh[1:len(dh) - k]).cumsum()
            late = np.append(dt[k:] * dt[:len(dt) - k], 0.0)[::-1].cumsum()   # late[i]: the last i products
            for i in range(m - k):
                out[i, i + k] = out[i + k, i] = self.dd[k] - early[start - i - 1] - late[i]
        t = np.arange(1, start)
        yd = np.array([self.yd[j] - (self.head[t[j:] - 1] * dh[t[j:] - j]).sum() for j in range(m)])
        ds = np.array([self.d - dh[1:start - j].sum() - dt[n - j - base:].sum() for j in range(m)])
        y, yy = self.y - self.head[:start - 1].sum(), self.yy - (self.head[:start - 1]**2).sum()
        x = np.zeros((m + 1, m + 1))
        x[0, :2] = x[:2, 0] = n - start, y
        x[1, 1] = yy
        x[0, 2:] = x[2:, 0] = ds[1:]
        x[1, 2:] = x[2:, 1] = yd[1:]
        x[2:, 2:] = out[1:, 1:]
        return x, np.concatenate([[ds[0], yd[0]], out[0, 1:]]), float(out[0, 0]), n - start


def lag_products(df: DataFrame, value: str, order, lags: int, shift: float, n: int,
                 block_rows: int = 1 << 16) -> LagProducts:
    """One Arrow pass over blocks of consecutive positions, each with the ``lags`` + 1 rows before it.

    Every block multiplies its own rows with itself lag by lag; the plan has the
    same width for any number of lags, and Spark adds up two numbers a lag and block.
    """
    import pyarrow as pa
    size = max(block_rows, 2 * lags + 4)
    halo = lags + 1
    rows = with_position(df.select(*order, (F.col(value) - F.lit(shift)).alias("y")), list(order)).select("_pos", "y")
    block = F.floor(F.col("_pos") / size)
    copies = rows.withColumn("block", F.explode(
        F.when(F.col("_pos") % size >= size - halo, F.array(block, block + 1)).otherwise(F.array(block))))

    def products(key, table):
        table = table.sort_by("_pos")
        pos, y = table["_pos"].to_numpy(), table["y"].to_numpy()
        own = int(np.searchsorted(pos, key[0].as_py() * size))      # rows before it are the halo
        d = np.append(0.0, np.diff(y))                     # 0 where the row before is missing or out of reach
        own_d, before = d[own:], np.append(0.0, y[:-1])[own:]
        if own == 0 and len(before):
            before[0] = 0.0                                # t = 0 has no row before it
        dd, yd = np.zeros(lags + 1), np.zeros(lags + 1)
        for k in range(lags + 1):
            at = max(own, k)
            past = d[at - k:len(d) - k]
            dd[k] = own_d[at - own:] @ past
            yd[k] = before[at - own:] @ past
        ends = [before.sum(), before @ before, own_d.sum()]
        n_out = lags + 1
        return pa.table({"kind": pa.array([0] * n_out + [1] * n_out + [2] * 3, pa.int32()),
                         "k": pa.array([*range(n_out), *range(n_out), 0, 1, 2], pa.int32()),
                         "x": pa.array(np.concatenate([dd, yd, ends]))})

    got = (copies.groupBy("block").applyInArrow(products, "kind int, k int, x double")
           .groupBy("kind", "k").agg(F.sum("x").alias("x")).collect())     # 2 * lags + 5 numbers
    parts = {(r["kind"], r["k"]): r["x"] for r in got}
    near = rows.filter((F.col("_pos") <= lags + 2) | (F.col("_pos") >= n - 2 * lags - 4)).collect()
    ends = {r["_pos"]: r["y"] for r in near}               # at most 3 * lags + 8 rows
    head = np.array([ends[p] for p in sorted(ends) if p <= lags + 2])
    tail = np.array([ends[p] for p in sorted(ends) if p >= n - 2 * lags - 4])
    return LagProducts(n, *(np.array([parts[(kind, k)] for k in range(lags + 1)]) for kind in (0, 1)),
                       *(parts[(2, k)] for k in range(3)), head, tail)


def adf(df: DataFrame, value: str = "pnl", order=("timestamp", "trade_id"), max_lag: int | None = None,
        lag: int | None = None, block_rows: int = 1 << 16) -> dict:
    """Augmented Dickey-Fuller with a constant; the lag is fixed or chosen by AIC up to ``max_lag``
    (NaN for fewer than 4 rows).

    One pass gives the lag products of the series; the Gramian of every
    candidate regression follows from them and the rows at both ends.
    """
    d = df.filter(F.col(value).isNotNull())
    r = d.agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("m")).first()
    n = r["n"]
    if n < 4:
        return {"adf_statistic": float("nan"), "adf_p_value": float("nan"), "used_lag": 0, "nobs": 0}
    L = lag if lag is not None else max_lag if max_lag is not None else int(math.ceil(12.0 * (n / 100.0) ** 0.25))
    L = max(0, min(L, n // 2 - 2))
    p = lag_products(d, value, order, L, r["m"], n, block_rows)

    def fit(use: int, start: int):
        X, Xy, yy, nn = p.gramian(use, start)
        k = 2 + use
        beta = np.linalg.lstsq(X, Xy, rcond=None)[0]
        ssr = float(yy - 2 * beta @ Xy + beta @ X @ beta)
        cov = ssr / (nn - k) * np.linalg.pinv(X)
        tstat = beta[1] / math.sqrt(cov[1, 1]) if cov[1, 1] > 0 else float("nan")
        llf = -nn / 2.0 * (math.log(2 * math.pi) + math.log(ssr / nn) + 1)
        return tstat, -2 * llf + 2 * k, nn

    best = L if lag is not None else min(range(L + 1), key=lambda use: (fit(use, L + 1)[1], use))
    tstat, _, nobs = fit(best, best + 1)
    return {"adf_statistic": float(tstat), "adf_p_value": adf_pvalue(tstat), "used_lag": best, "nobs": int(nobs)}


KPSS_CRITICAL = {0.10: 0.347, 0.05: 0.463, 0.025: 0.574, 0.01: 0.739}  # level stationarity


def _bartlett(sums: DataFrame, n: int, total: float, lags: Sequence[int]) -> list[float]:
    """Bartlett long-run variances from prefix sums (_pos, _S), one per truncation lag.

    With weights 1 - k / (l + 1) the variance is the mean square of the moving
    sums of l + 1 values (zeros beyond both ends), S_t - S_{t-l-1}: one join of
    the prefix sums with themselves at that distance, whatever the lag.
    """
    out = []
    for lag in lags:
        back = sums.select((F.col("_pos") + lag + 1).alias("_pos"), F.col("_S").alias("_B"))
        moved = sums.join(back, "_pos", "full").select(
            (F.coalesce("_S", F.lit(total)) - F.coalesce("_B", F.lit(0.0))).alias("m"))
        out.append(moved.agg(F.sum(F.col("m") * F.col("m"))).first()[0] / (n * (lag + 1)))
    return out


def kpss(df: DataFrame, value: str = "pnl", order=("timestamp", "trade_id"),
         block_rows: int | None = None) -> dict:
    """KPSS level test, automatic (Hobijn et al. 1998) lag, Bartlett long-run variance (NaN without rows).

    Everything follows from one prefix sum of the residuals.  The lag rule needs
    the plain and the lag-weighted sum of c autocovariances; both are
    differences of two Bartlett variances with neighbouring lags.
    """
    d = df.filter(F.col(value).isNotNull())
    r = d.agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("m")).first()
    n, c = r["n"], int(r["n"] ** (2.0 / 9.0))
    if n == 0:
        return {"kpss_statistic": float("nan"), "kpss_p_value": float("nan"), "lags": 0}
    rng = ranged(d.select(*order, (F.col(value) - F.lit(r["m"])).alias("_e")), list(order),
                 math.ceil(n / block_rows) if block_rows else None)
    sums = with_position(running_aggs(rng, {"_S": ("sum", F.col("_e"))}, keep_blocks=True)).select("_pos", "_S")
    sums = materialize(sums)
    e = sums.agg(F.sum(F.col("_S") * F.col("_S")).alias("ss"), F.max_by("_S", "_pos").alias("total")).first()
    total = e["total"] or 0.0
    wide, narrow = _bartlett(sums, n, total, (c, c - 1)) if c > 0 else (_bartlett(sums, n, total, (0,)) * 2)
    s0 = (c + 1) * wide - c * narrow                       # g_0 + 2 (g_1 + .. + g_c)
    s1 = (c + 1) * (s0 - wide)                             # 2 (1 g_1 + .. + c g_c)
    lag = int(1.1447 * ((s1 / s0) ** 2) ** (1.0 / 3.0) * n ** (1.0 / 3.0)) if s0 else 0
    lag = min(lag, n - 1)
    lrv = _bartlett(sums, n, total, (lag,))[0]
    stat = e["ss"] / (n * n) / lrv if lrv else float("nan")
    crit = sorted(KPSS_CRITICAL.items(), key=lambda kv: kv[1])
    p = float(np.interp(stat, [v for _, v in crit], [p for p, _ in crit]))
    return {"kpss_statistic": float(stat), "kpss_p_value": min(max(p, 0.01), 0.10), "lags": lag}


def audit_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: column count, rows, all-null columns (one aggregate per table)."""
    rows = []
    spark = None
    for name, df in tables.items():
        spark = df.sparkSession
        r = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(f"c{i}")
                                                        for i, c in enumerate(df.columns)]).first()
        nulls = [c for i, c in enumerate(df.columns) if r["_rows"] > 0 and r[f"c{i}"] == 0]
        rows.append((name, len(df.columns), int(r["_rows"]), ",".join(nulls), r["_rows"] == 0))
    return spark.createDataFrame(rows, "table string, columns int, rows long, orphaned_columns string, empty boolean")


def check_metrics(fold_results: DataFrame) -> DataFrame:
    """Folds whose MAE or R2 is NULL / NaN."""
    bad = (F.col("mae").isNull() | F.isnan("mae") | F.col("r2").isNull() | F.isnan("r2"))
    return fold_results.select("fold", "mae", "r2").filter(bad)
