import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from quantspark.plans import diagnose as dg


def _series(spark, values):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "trade_id long, timestamp timestamp, pnl double")


def test_acf_matches_numpy(spark):
    x = np.random.default_rng(1).normal(size=300).cumsum()
    got = [r["acf"] for r in dg.acf(_series(spark, x), lags=5, block_rows=64).orderBy("lag").collect()]
    d = x - x.mean()
    exp = [float(d[k:] @ d[:len(d) - k] / (d @ d)) for k in range(6)]
    assert np.allclose(got, exp, atol=1e-10)


def test_adf_and_kpss_separate_noise_from_random_walk(spark):
    rng = np.random.default_rng(2)
    noise, walk = rng.normal(size=400), rng.normal(size=400).cumsum()
    a_noise = dg.adf(_series(spark, noise), block_rows=128)
    a_walk = dg.adf(_series(spark, walk), block_rows=128)
    assert a_noise["adf_p_value"] < 0.01 < a_walk["adf_p_value"]
    k_noise = dg.kpss(_series(spark, noise), block_rows=128)
    k_walk = dg.kpss(_series(spark, walk), block_rows=128)
    assert k_noise["kpss_p_value"] >= 0.05 and k_walk["kpss_p_value"] == 0.01


def test_collinearity_flags_duplicates(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=200), rng.normal(size=200)
    rows = [(float(x), float(y), float(x)) for x, y in zip(a, b)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    summary, corr, vif, high = dg.collinearity(df, ["a", "b", "c"])
    assert summary["rank"] == 2 and summary["rank_deficient"]
    assert {(r["feature_a"], r["feature_b"]) for r in high.collect()} == {("c", "a")}


def test_feature_statistics_and_audit(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1.0, None), (2, dt.datetime(2024, 1, 2), 3.0, None),
                                (3, dt.datetime(2024, 1, 3), float("inf"), None)],
                               "trade_id long, trade_timestamp timestamp, x double, y double")
    st = {r["feature"]: r for r in dg.feature_statistics(df, None, ["x", "y"]).collect()}
    assert st["x"]["mean"] == 2.0 and st["x"]["infinite"] == 1 and st["y"]["constant"]
    assert st["x"]["first_appearance"] == dt.datetime(2024, 1, 1)
    audit = dg.audit_tables({"t": df}).first()
    assert audit["orphaned_columns"] == "y" and audit["rows"] == 3


def _plain_adf(y, lag, start):
    """Regression of the differences on a constant, the level before and ``lag`` lagged differences."""
    d = np.append(0.0, np.diff(y))
    t = np.arange(start, len(y))
    X = np.column_stack([np.ones(len(t)), y[t - 1], *[d[t - j] for j in range(1, lag + 1)]])
    beta, *_ = np.linalg.lstsq(X, d[t], rcond=None)
    res = d[t] - X @ beta
    cov = res @ res / (len(t) - X.shape[1]) * np.linalg.inv(X.T @ X)
    llf = -len(t) / 2 * (np.log(2 * np.pi) + np.log(res @ res / len(t)) + 1)
    return beta[1] / np.sqrt(cov[1, 1]), -2 * llf + 2 * X.shape[1], len(t)


def test_adf_equals_plain_regressions(spark):
    rng = np.random.default_rng(11)
    y = rng.normal(size=260)
    for i in range(3, 260):
        y[i] += 0.5 * y[i - 1] - 0.3 * y[i - 3]
    y = y * 7 + 1000
    top = 16
    best = min(range(top + 1), key=lambda k: _plain_adf(y, k, top + 1)[1])
    want = _plain_adf(y, best, best + 1)
    for block_rows in (40, 64, 10**6):                    # blocks smaller and larger than the series
        got = dg.adf(_series(spark, y), max_lag=top, block_rows=block_rows)
        assert (got["used_lag"], got["nobs"]) == (best, want[2])
        assert np.isclose(got["adf_statistic"], want[0], rtol=1e-8)
    got = dg.adf(_series(spark, y[:12]), lag=2)
    assert np.isclose(got["adf_statistic"], _plain_adf(y[:12], 2, 3)[0], rtol=1e-8)


def test_kpss_equals_plain_sums(spark):
    rng = np.random.default_rng(12)
    for y in (rng.normal(size=333), rng.normal(size=200).cumsum(), np.arange(9.0)):
        n, e = len(y), y - y.mean()
        g = [e[k:] @ e[:n - k] / n for k in range(n)]
        c = int(n ** (2 / 9))
        s0, s1 = g[0] + 2 * sum(g[1:c + 1]), 2 * sum(k * g[k] for k in range(1, c + 1))
        lag = min(int(1.1447 * ((s1 / s0)**2)**(1 / 3) * n**(1 / 3)), n - 1)
        lrv = g[0] + 2 * sum((1 - k / (lag + 1)) * g[k] for k in range(1, lag + 1))
        got = dg.kpss(_series(spark, y))
        assert got["lags"] == lag and np.isclose(got["kpss_statistic"], (e.cumsum()**2).sum() / n**2 / lrv)


def test_stationarity_of_empty_series(spark):
    empty = _series(spark, [1.0]).limit(0)
    assert np.isnan(dg.adf(empty)["adf_statistic"]) and np.isnan(dg.kpss(empty)["kpss_statistic"])


def test_adf_plan_does_not_widen_with_lags(spark, monkeypatch):
    """The frame that the lag products are taken from has the same columns for 2 and for 40 lags."""
    widths = []
    original = dg.with_position

    def seen(df, *args, **kwargs):
        out = original(df, *args, **kwargs)
        widths.append(len(out.columns))
        return out

    monkeypatch.setattr(dg, "with_position", seen)
    y = np.random.default_rng(3).normal(size=150)
    for lag in (2, 40):
        dg.adf(_series(spark, y), lag=lag)
    assert len(set(widths)) == 1
