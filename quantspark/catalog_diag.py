"""Registered diagnostics queries (M) and attribution reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantspark.catalog import ORACLE, _feature_store, _trades, _with, feature_store_ctes, register
from quantspark.catalog_eval import PRED, T, _DRIFT_COLS, _preds
from quantspark.catalog_model import MATRIX_SQL, _fit_matrix
from quantspark.plans import diagnose as dg
from quantspark.plans import evaluate as ev
from quantspark.plans import model as mdl
from quantspark.sources import fixtures as fx


def _fs_with_ts(spark, sf):
    return _feature_store(spark, sf)


_FS_TS = """
ft AS (SELECT fs.*, t."timestamp" AS trade_timestamp FROM fs JOIN trades t ON fs.trade_id = t.id)"""
_UNPIV = f"""
lg AS (FROM (SELECT trade_timestamp, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _DRIFT_COLS)} FROM ft)
       UNPIVOT INCLUDE NULLS (v FOR feature IN ({", ".join(_DRIFT_COLS)})))"""
_M1_BODY = """
m1 AS (
  SELECT feature, avg(cv) AS mean,
         CASE WHEN count(cv) > 1 THEN stddev_samp(cv) END AS std, min(cv) AS min, max(cv) AS max,
         CASE WHEN count(cv) > 2 THEN skewness(cv) END AS skewness,
         CASE WHEN count(cv) > 3 THEN kurtosis(cv) END AS kurtosis,
         count_if(v IS NULL OR isnan(v)) AS missing,
         count_if(v IS NULL OR isnan(v)) / count(*) * 100.0 AS pct_missing,
         count_if(isinf(v)) AS infinite, count_if(isinf(v)) / count(*) * 100.0 AS pct_infinite,
         CASE WHEN min(cv) IS NULL THEN true ELSE min(cv) = max(cv) END AS constant,
         min(CASE WHEN v IS NOT NULL AND NOT isnan(v) THEN trade_timestamp END) AS first_appearance,
         max(CASE WHEN v IS NOT NULL AND NOT isnan(v) THEN trade_timestamp END) AS last_appearance
  FROM (SELECT *, CASE WHEN NOT isinf(v) AND NOT isnan(v) THEN v END AS cv FROM lg) GROUP BY feature)"""


def _m1(spark, sf):
    f = _fs_with_ts(spark, sf)
    return dg.feature_statistics(f, _trades(spark, sf), _DRIFT_COLS)


register("m1_m2_feature_statistics", _with(*feature_store_ctes(), _FS_TS, _UNPIV, _M1_BODY) + "SELECT * FROM m1")(_m1)

register("m8_suspicious_features", _with(*feature_store_ctes(), _FS_TS, _UNPIV, _M1_BODY) + """
SELECT feature, concat_ws(',', CASE WHEN constant THEN 'constant' END, CASE WHEN pct_missing > 10 THEN 'missing' END,
                          CASE WHEN infinite > 0 THEN 'infinite' END) AS reasons
FROM m1 WHERE constant OR pct_missing > 10 OR infinite > 0""")(lambda spark, sf: dg.suspicious_features(_m1(spark, sf)))


def _collinearity(spark, sf):
    f = _fs_with_ts(spark, sf)
    summary, corr, vif, high = dg.collinearity(f, _DRIFT_COLS)
    return corr, vif, high, summary


register("m6_correlation_matrix")(lambda spark, sf: _collinearity(spark, sf)[0])
register("m5_vif")(lambda spark, sf: _collinearity(spark, sf)[1])
register("m7_high_correlation_pairs")(lambda spark, sf: _collinearity(spark, sf)[2])


def _m3_m4(spark, sf):
    s = _collinearity(spark, sf)[3]
    return spark.createDataFrame([(s["rows"], float(s["condition_number"]), s["rank"], s["features"],
                                   bool(s.get("rank_deficient", False)))],
                                 "rows long, condition_number double, rank int, features int, rank_deficient boolean")


register("m3_m4_condition_and_rank")(_m3_m4)


def _m9(spark, sf):
    f = _fs_with_ts(spark, sf).join(_trades(spark, sf).select(F.col("id").alias("trade_id"), "timestamp"), "trade_id")
    return dg.sanity(f, _DRIFT_COLS, "timestamp", "pnl")


_M9_SQL = _with(*feature_store_ctes(), """
ft AS (SELECT fs.*, t."timestamp" AS ts FROM fs JOIN trades t ON fs.trade_id = t.id)""", """
dup AS (SELECT coalesce(sum(c), 0) AS duplicate_timestamp_rows FROM (SELECT count(*) AS c FROM ft GROUP BY ts)
        WHERE c > 1)""") + f"""
SELECT sum({" + ".join(f"CASE WHEN isinf(CAST({c} AS DOUBLE)) THEN 1 ELSE 0 END" for c in _DRIFT_COLS)})
         AS infinite_values,
       var_samp(pnl) AS target_variance,
       (SELECT duplicate_timestamp_rows FROM dup) AS duplicate_timestamp_rows,
       (SELECT duplicate_timestamp_rows FROM dup) = 0
         AND sum({" + ".join(f"CASE WHEN isinf(CAST({c} AS DOUBLE)) THEN 1 ELSE 0 END" for c in _DRIFT_COLS)}) = 0
         AND NOT (var_samp(pnl) = 0) AS passed
FROM ft"""
register("m9_matrix_sanity", _M9_SQL)(_m9)


def _m10(spark, sf):
    return dg.prediction_sanity(_preds(spark, sf))


register("m10_prediction_sanity", _with(T, PRED) + """
SELECT min(predicted_pnl) = max(predicted_pnl) AS collapsed,
       count_if(predicted_pnl IS NULL OR isnan(predicted_pnl)) AS invalid_predictions FROM predictions""")(_m10)

register("m11_target_statistics", _with(*feature_store_ctes(), """
st AS (SELECT count(pnl) AS n, avg(pnl) AS mean, var_samp(pnl) AS variance, stddev_samp(pnl) AS std,
              skewness(pnl) AS skewness, kurtosis(pnl) AS kurtosis, stddev_pop(pnl) AS sp,
              avg(power(pnl - (SELECT avg(pnl) FROM fs), 3)) AS m3, avg(power(pnl - (SELECT avg(pnl) FROM fs), 4)) AS m4,
              var_pop(pnl) AS m2
       FROM fs WHERE pnl IS NOT NULL)""") + """
SELECT n, mean, variance, std, skewness, kurtosis, CASE WHEN std <> 0 THEN mean / std END AS snr,
       (SELECT avg(CASE WHEN abs((pnl - st.mean) / st.sp) > 3 THEN 1.0 ELSE 0.0 END) * 100.0 FROM fs
        WHERE pnl IS NOT NULL) AS outliers_pct,
       n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4.0) AS jb_statistic,
       exp(-(n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4.0)) / 2.0) AS jb_p_value
FROM st WHERE n >= 10""")(lambda spark, sf: dg.target_statistics(_fs_with_ts(spark, sf)))

_LAGS = 40
_ACF_SQL = _with(T, """
x AS (SELECT "timestamp", id, pnl - (SELECT avg(pnl) FROM trades) AS e FROM trades WHERE pnl IS NOT NULL)""",
                 "l AS (SELECT e, " + ", ".join(f'lag(e, {k}) OVER (ORDER BY "timestamp", id) AS l{k}'
                                                for k in range(1, _LAGS + 1)) + " FROM x)") + """
SELECT CAST(k AS INTEGER) AS lag, s / (SELECT sum(e * e) FROM l) AS acf FROM (
  SELECT 0 AS k, sum(e * e) AS s FROM l UNION ALL """ + " UNION ALL ".join(
    f"SELECT {k}, sum(e * l{k}) FROM l" for k in range(1, _LAGS + 1)) + ")"

register("m14_acf", _ACF_SQL)(lambda spark, sf: dg.acf(_trades(spark, sf), "pnl", ("timestamp", "id"), _LAGS))
register("m15_pacf")(lambda spark, sf: dg.pacf(_trades(spark, sf), "pnl", ("timestamp", "id"), _LAGS))


def _m12(spark, sf):
    r = dg.adf(_trades(spark, sf), "pnl", ("timestamp", "id"))
    return spark.createDataFrame([(r["adf_statistic"], r["adf_p_value"], r["used_lag"], r["nobs"])],
                                 "adf_statistic double, adf_p_value double, used_lag int, nobs long")


def _m13(spark, sf):
    r = dg.kpss(_trades(spark, sf), "pnl", ("timestamp", "id"))
    return spark.createDataFrame([(r["kpss_statistic"], r["kpss_p_value"], r["lags"])],
                                 "kpss_statistic double, kpss_p_value double, lags int")


register("m12_adf")(_m12)

# One lag by Frisch-Waugh: both sides freed of the constant and the lagged difference, then one slope.
register("m12_adf_one_lag", _with(T, """
x AS (SELECT pnl AS y0, lag(pnl, 1) OVER w AS y1, lag(pnl, 2) OVER w AS y2 FROM trades WHERE pnl IS NOT NULL
      WINDOW w AS (ORDER BY "timestamp", id))""", """
d AS (SELECT y0 - y1 AS dy, y1, y1 - y2 AS dl FROM x WHERE y2 IS NOT NULL)""", """
f AS (SELECT regr_slope(dy, dl) AS b, regr_intercept(dy, dl) AS a, regr_slope(y1, dl) AS q, regr_intercept(y1, dl) AS p FROM d)""",
                                 """
r AS (SELECT dy - a - b * dl AS ry, y1 - p - q * dl AS rx FROM d, f)""", """
s AS (SELECT sum(rx * ry) / sum(rx * rx) AS slope, sum(rx * rx) AS xx, count(*) AS n FROM r)""") + """
SELECT (SELECT slope FROM s) / sqrt(sum(power(ry - slope * rx, 2)) / (max(n) - 3) / max(xx)) AS adf_statistic,
       1 AS used_lag, max(n) AS nobs FROM r, s""")(
    lambda spark, sf: spark.createDataFrame(
        [(r["adf_statistic"], r["used_lag"], r["nobs"]) for r in [dg.adf(_trades(spark, sf), "pnl", ("timestamp", "id"), lag=1)]],
        "adf_statistic double, used_lag int, nobs long"))

register("m13_kpss", _with(T, """
x AS (SELECT pnl - (SELECT avg(pnl) FROM trades) AS e, row_number() OVER (ORDER BY "timestamp", id) - 1 AS t FROM trades
      WHERE pnl IS NOT NULL)""", """
n AS (SELECT count(*) AS n, floor(power(count(*), 2.0 / 9.0)) AS c FROM x)""", """
g AS (SELECT k, sum(a.e * b.e) / max(n) AS g FROM range(0, 400) r(k) JOIN x a ON true JOIN x b ON b.t = a.t - k, n GROUP BY k)""",
                           """
h AS (SELECT sum(CASE WHEN k = 0 THEN g ELSE 2 * g END) AS s0, sum(2 * k * g) AS s1 FROM g, n WHERE k <= c)""", """
l AS (SELECT floor(1.1447 * power(power(s1 / s0, 2), 1.0 / 3) * power(n, 1.0 / 3)) AS lag FROM h, n)""", """
v AS (SELECT sum(CASE WHEN k = 0 THEN g ELSE 2 * (1 - k / (lag + 1)) * g END) AS lrv FROM g, l WHERE k <= lag)""", """
p AS (SELECT sum(power(s, 2)) / power(max(n), 2) AS eta FROM (SELECT sum(e) OVER (ORDER BY t) AS s FROM x), n)""", """
k AS (SELECT eta / lrv AS stat FROM p, v)""") + """
SELECT stat AS kpss_statistic, CAST(lag AS INTEGER) AS lags,
       CASE WHEN stat <= 0.347 THEN 0.1 WHEN stat <= 0.463 THEN 0.1 - 0.05 * (stat - 0.347) / 0.116
            WHEN stat <= 0.574 THEN 0.05 - 0.025 * (stat - 0.463) / 0.111
            WHEN stat <= 0.739 THEN 0.025 - 0.015 * (stat - 0.574) / 0.165 ELSE 0.01 END AS kpss_p_value
FROM k, l""")(_m13)


def _m16(spark, sf):
    t = _trades(spark, sf)
    return dg.audit_tables({"trades": t, "macro_series": fx.macro_from_orders(spark, sf),
                            "predictions": fx.predictions_from_trades(t)})


register("m16_table_audit", _with(T, PRED, fx.macro_sql()) + """
SELECT 'trades' AS "table", 10 AS columns, count(*) AS "rows",
       concat_ws(',', CASE WHEN count(*) > 0 AND count(id) = 0 THEN 'id' END,
                 CASE WHEN count(*) > 0 AND count(holding_time) = 0 THEN 'holding_time' END) AS orphaned_columns,
       count(*) = 0 AS empty FROM trades
UNION ALL SELECT 'macro_series', 6, count(*), '', count(*) = 0 FROM macro_series
UNION ALL SELECT 'predictions', 7, count(*), '', count(*) = 0 FROM predictions""")(_m16)


def _ols(spark, sf):
    m = _fit_matrix(spark, sf)
    feats = mdl.feature_columns(m)
    return m, mdl.fit_linear("linear_regression", {}, m, feats)


def _l21(spark, sf):
    _, model = _ols(spark, sf)
    imp = spark.createDataFrame(list(model.native_importance().items()), "feature string, importance double")
    return ev.top_k(imp, "importance", 20)


def _l22(spark, sf):
    m, model = _ols(spark, sf)
    return ev.mean_abs_attribution(mdl.linear_attribution(model, m), 20)


register("j16_l21_top_features")(_l21)
register("j18_l22_linear_attribution")(_l22)


def _j17(spark, sf):
    m, model = _ols(spark, sf)
    return mdl.permutation_importance(model, m, "pnl", repeats=5, seed=42)


register("j17_permutation_importance")(_j17)

# One feature, whose least-squares line SQL fits itself; the partner rows follow from the same arithmetic.
register("j17_permutation_importance_one_feature", _with(*feature_store_ctes(), MATRIX_SQL, """
x AS (SELECT row_number() OVER (ORDER BY trade_timestamp, trade_id) - 1 AS p, hour_of_day::DOUBLE AS f, pnl AS y FROM m)""",
                                                         """
o AS (SELECT regr_slope(y, f) AS w, regr_intercept(y, f) AS c, avg(y) AS ybar, count(*) AS n FROM x)""", """
s AS (SELECT r, n // 5 + ((42 + r) * 2654435761) % greatest(1, 3 * n // 5) AS st, ((42 + r) * 2654435761 * 40503) % n AS b
      FROM range(5) t(r), o)""", """
ab AS (SELECT r, min(b) AS b, min(st + v) AS a FROM s, o, range(1000) t(v) WHERE gcd(st + v, n) = 1 GROUP BY r)""", """
e AS (SELECT r, sum(power(x.y - c - w * z.f, 2)) AS sse, sum(power(x.y - c - w * x.f, 2)) AS base,
             sum(power(x.y - ybar, 2)) AS sst
      FROM ab, o, x JOIN x z ON z.p = (a * x.p + b) % n GROUP BY r)""") + """
SELECT 'hour_of_day' AS feature, avg((sse - base) / sst) AS importance FROM e""")(
    lambda spark, sf: (lambda m: mdl.permutation_importance(
        mdl.fit_linear("linear_regression", {}, m, ["hour_of_day"]), m, "pnl", repeats=5, seed=42))(_fit_matrix(spark, sf)))


_CC = " AND ".join(f"{c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE)) AND NOT isinf(CAST({c} AS DOUBLE))"
                   for c in _DRIFT_COLS)
_CORR_SQL = [_FS_TS, f"""
cc AS (SELECT row_number() OVER () AS rid, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _DRIFT_COLS)}
       FROM ft WHERE {_CC})""", f"""
clg AS (FROM cc UNPIVOT (v FOR feature IN ({", ".join(_DRIFT_COLS)})))""", """
cstat AS (SELECT feature, min(v) < max(v) AS varying FROM clg GROUP BY feature)""", """
cpairs AS (SELECT a.feature AS feature_a, b.feature AS feature_b,
                  CASE WHEN sa.varying AND sb.varying THEN corr(a.v, b.v) END AS corr
           FROM clg a JOIN clg b USING (rid) JOIN cstat sa ON sa.feature = a.feature
           JOIN cstat sb ON sb.feature = b.feature GROUP BY a.feature, b.feature, sa.varying, sb.varying)""",
             "forder AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', {i})" for i, c in enumerate(_DRIFT_COLS))
             + ") t(feature, idx))"]

ORACLE["m6_correlation_matrix"] = _with(*feature_store_ctes(), *_CORR_SQL) + "SELECT * FROM cpairs"
ORACLE["m7_high_correlation_pairs"] = _with(*feature_store_ctes(), *_CORR_SQL) + """
SELECT p.feature_a, p.feature_b, p.corr FROM cpairs p JOIN forder fa ON fa.feature = p.feature_a
JOIN forder fb ON fb.feature = p.feature_b WHERE fa.idx > fb.idx AND abs(p.corr) > 0.9"""
