"""Registered walk-forward and evaluation queries (I, J13/J15, L) with oracle SQL.

Predictions come from the deterministic fixture of ``sources.fixtures``
(previous pnl of the group, on the test rows of each fold), so every
evaluation query is checkable in SQL without a trained model.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quantspark.catalog import (BLOCKED, ORACLE, QUERIES, _trades, _with, feature_store_ctes, register,
                                _feature_store)
from quantspark.plans import evaluate as ev
from quantspark.plans import folds as fo
from quantspark.plans import macro
from quantspark.plans.selection import fold_metrics, select_best, training_summary
from quantspark.session import prepare_session
from quantspark.sources import fixtures as fx

FP = fx.fixture_params()
BASELINE_PERM = "P_view"  # a permutation of the fixture used as the baseline portfolio
ORDER = ["timestamp", "trade_id"]
T = fx.TRADES_EVENTS_SQL
PRED = fx.PREDICTIONS_SQL


def _preds(spark, sf):
    return fx.predictions_from_trades(_trades(spark, sf))


# ---------------------------------------------------------------------------
# I: folds
# ---------------------------------------------------------------------------

register("i1_walk_forward_folds", _with(T, fx.folds_sql()) + "SELECT * FROM folds")(
    lambda spark, sf: fo.valid_folds(_trades(spark, sf), "timestamp", FP))


def _i3(spark, sf):
    t = _trades(spark, sf).withColumnRenamed("id", "trade_id")
    return fo.check_folds(fo.assign_folds(t, "timestamp", FP))


_I3_SQL = _with(T, fx.folds_sql(), """
a AS (SELECT f.walk_forward_fold, m.id, m."timestamp", m.split FROM fold_member m JOIN folds f USING (k))""", """
shared AS (SELECT x.walk_forward_fold, count(*) AS n FROM a x JOIN a y
           ON x.walk_forward_fold = y.walk_forward_fold AND x.id = y.id AND x.split = 'train' AND y.split = 'test'
           GROUP BY 1)""") + """
SELECT a.walk_forward_fold,
       max(CASE WHEN split = 'train' THEN "timestamp" END) AS max_train_ts,
       min(CASE WHEN split = 'test' THEN "timestamp" END) AS min_test_ts,
       CAST(coalesce(max(shared.n), 0) AS BIGINT) AS shared_ids,
       (max(CASE WHEN split = 'train' THEN "timestamp" END) >= min(CASE WHEN split = 'test' THEN "timestamp" END))
         OR coalesce(max(shared.n), 0) > 0 AS leak
FROM a LEFT JOIN shared USING (walk_forward_fold) GROUP BY a.walk_forward_fold"""
register("i3_fold_leakage_check", _I3_SQL)(_i3)


@register("i4_time_series_splits", _with(T, fx.folds_sql(), """
tr AS (SELECT f.walk_forward_fold, m.id AS trade_id, m."timestamp",
              row_number() OVER (PARTITION BY f.walk_forward_fold ORDER BY m."timestamp", m.id) - 1 AS p,
              count(*) OVER (PARTITION BY f.walk_forward_fold) AS n
       FROM fold_member m JOIN folds f USING (k) WHERE m.split = 'train')""", """
sp AS (SELECT tr.*, s.i AS cv_split, n - (3 - s.i) * (n // 4) AS v0 FROM tr, range(0, 3) s(i))""") + """
SELECT walk_forward_fold, trade_id, "timestamp", CAST(cv_split AS INTEGER) AS cv_split,
       CASE WHEN p < v0 THEN 'fit' ELSE 'val' END AS cv_role
FROM sp WHERE p < v0 + (n // 4)""")
def _i4(spark, sf):
    t = _trades(spark, sf).withColumnRenamed("id", "trade_id")
    a = fo.assign_folds(t.select("trade_id", "timestamp"), "timestamp", FP, splits=("train",))
    return fo.time_series_splits(a.drop("split")).select(
        "walk_forward_fold", "trade_id", "timestamp", "cv_split", "cv_role")


register("i_predictions_fixture", _with(T, PRED) + "SELECT * FROM predictions")(_preds)

# ---------------------------------------------------------------------------
# J13 / J15 on fixture candidates; L11, L26
# ---------------------------------------------------------------------------

CANDIDATES = [("previous_pnl", "predicted_pnl"), ("zero", "0.0"), ("half_previous", "0.5 * predicted_pnl")]


def _fold_results(spark, sf):
    t = _trades(spark, sf)
    preds = fx.predictions_from_trades(t)
    cands = preds.select("walk_forward_fold", "actual_pnl", F.explode(F.array(*[
        F.struct(F.lit(n).alias("model"), F.lit(i).alias("model_order"), F.expr(e).alias("predicted_pnl"))
        for i, (n, e) in enumerate(CANDIDATES)])).alias("_c")).select("walk_forward_fold", "actual_pnl", "_c.*")
    scores = ev.regression_metrics(cands, by=["walk_forward_fold", "model", "model_order"])
    best = select_best(scores)
    test = cands.join(best.select("walk_forward_fold", F.col("best_model").alias("model")),
                      ["walk_forward_fold", "model"])
    windows = fo.fold_windows(fo.assign_folds(t, "timestamp", FP))
    return fold_metrics(test, windows, best, fx.FIXTURE_EXPERIMENT).drop("metrics")


_cand_sql = " UNION ALL ".join(
    f"SELECT walk_forward_fold, actual_pnl, '{n}' AS model, {i} AS model_order, CAST({e} AS DOUBLE) AS pred "
    f"FROM predictions" for i, (n, e) in enumerate(CANDIDATES))
FOLD_RESULTS_SQL = [f"cands AS ({_cand_sql})", """
scores AS (SELECT walk_forward_fold, model, model_order, avg(abs(pred - actual_pnl)) AS mae
           FROM cands GROUP BY ALL)""", """
best AS (SELECT walk_forward_fold, arg_min(model, (mae, model_order)) AS best_model FROM scores GROUP BY 1)""", """
fm AS (SELECT c.walk_forward_fold, count(*) AS n, avg(abs(pred - actual_pnl)) AS mae,
              sqrt(avg((pred - actual_pnl) * (pred - actual_pnl))) AS rmse,
              sum((pred - actual_pnl) * (pred - actual_pnl)) AS sse, var_pop(actual_pnl) * count(*) AS sst
       FROM cands c JOIN best b ON c.walk_forward_fold = b.walk_forward_fold AND c.model = b.best_model
       GROUP BY 1)""", """
win AS (SELECT f.walk_forward_fold, count_if(m.split = 'train') AS train_size, count_if(m.split = 'test') AS test_size,
               min(CASE WHEN m.split = 'train' THEN m."timestamp" END) AS train_start,
               max(CASE WHEN m.split = 'train' THEN m."timestamp" END) AS train_end,
               min(CASE WHEN m.split = 'test' THEN m."timestamp" END) AS test_start,
               max(CASE WHEN m.split = 'test' THEN m."timestamp" END) AS test_end
        FROM fold_member m JOIN folds f USING (k) GROUP BY 1)""", """
fold_results AS (
  SELECT fm.walk_forward_fold AS fold, b.best_model, fm.mae, fm.rmse,
         CASE WHEN fm.n <= 1 THEN 0.0 WHEN fm.sst > 0 THEN 1 - fm.sse / fm.sst
              WHEN fm.sse = 0 THEN 1.0 ELSE 0.0 END AS r2,
         w.train_size, w.test_size, w.train_start, w.train_end, w.test_start, w.test_end,
         'exp_fixture' AS experiment_id
  FROM fm JOIN best b USING (walk_forward_fold) JOIN win w USING (walk_forward_fold))"""]

register("j13_fold_results", _with(T, PRED, *FOLD_RESULTS_SQL) + "SELECT * FROM fold_results")(_fold_results)

register("j15_training_summary", _with(T, PRED, *FOLD_RESULTS_SQL, """
w AS (SELECT best_model, count(*) AS c, min(fold) AS f FROM fold_results GROUP BY 1)""") + """
SELECT count(*) AS folds, avg(mae) AS mean_mae, stddev_pop(mae) AS std_mae, avg(rmse) AS mean_rmse,
       avg(r2) AS mean_r2,
       (SELECT best_model FROM w ORDER BY c DESC, f LIMIT 1) AS most_selected_model,
       (SELECT '{' || string_agg('"' || best_model || '":' || c, ',' ORDER BY f) || '}' FROM w) AS model_selection_counts
FROM fold_results""")(lambda spark, sf: training_summary(_fold_results(spark, sf)))

register("l11_model_stability", _with(T, PRED, *FOLD_RESULTS_SQL) + """
SELECT best_model AS model, count(*) AS folds_won, avg(mae) AS mean_mae, stddev_samp(mae) AS std_mae,
       CASE WHEN avg(mae) > 0 THEN stddev_samp(mae) / avg(mae) ELSE 0.0 END AS cv_mae,
       CASE WHEN count(*) > 1 THEN avg(mae) - 1.96 * stddev_samp(mae) / sqrt(count(*)) ELSE avg(mae) END AS ci_95_lower,
       CASE WHEN count(*) > 1 THEN avg(mae) + 1.96 * stddev_samp(mae) / sqrt(count(*)) ELSE avg(mae) END AS ci_95_upper,
       count(*) / (SELECT count(DISTINCT fold) FROM fold_results) AS win_share
FROM fold_results GROUP BY best_model""")(lambda spark, sf: ev.model_stability(_fold_results(spark, sf)))

register("l26_model_comparison", _with(T, PRED, *FOLD_RESULTS_SQL, """
g AS (SELECT best_model, avg(mae) AS mae, avg(rmse) AS rmse, avg(r2) AS r2, count(*) AS folds
      FROM fold_results GROUP BY 1)""") + """
SELECT best_model, mae, rmse, r2, folds, best_model = (SELECT arg_min(best_model, (mae, best_model)) FROM g) AS is_best,
       CASE WHEN r2 < 0 THEN 'negative_r2' WHEN r2 < 0.1 THEN 'low_r2' ELSE 'meaningful_r2' END AS r2_finding
FROM g""")(lambda spark, sf: ev.model_comparison(_fold_results(spark, sf)))

register("l26_fold_summary", _with(T, PRED, *FOLD_RESULTS_SQL) + """
SELECT count(*) AS folds, avg(mae) AS avg_mae, avg(rmse) AS avg_rmse, avg(r2) AS avg_r2,
       avg(train_size) AS avg_train_size, avg(test_size) AS avg_test_size FROM fold_results""")(
    lambda spark, sf: ev.fold_summary(_fold_results(spark, sf)))

# ---------------------------------------------------------------------------
# L1, L2, L3, L4, L5
# ---------------------------------------------------------------------------


def regression_sql(src: str, y: str, yhat: str, by: str | None) -> str:
    g = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    e = f"({yhat} - {y})"
    part = f"PARTITION BY {by}" if by else ""
    d = f"({y} - ybar)"
    return f"""SELECT {g}count(*) AS n, avg(abs({e})) AS mae, sqrt(avg({e} * {e})) AS rmse,
  CASE WHEN sum({d} * {d}) > 0 THEN 1 - sum({e} * {e}) / sum({d} * {d})
       WHEN sum({e} * {e}) = 0 THEN 1.0 ELSE 0.0 END AS r2
FROM (SELECT *, avg({y}) OVER ({part}) AS ybar FROM {src}) rm{grp}"""


register("l1_regression_metrics_by_fold", _with(T, PRED) + regression_sql(
    "predictions", "actual_pnl", "predicted_pnl", "walk_forward_fold"))(
    lambda spark, sf: ev.regression_metrics(_preds(spark, sf), by=["walk_forward_fold"]))


def trading_sql(src: str, value: str, order: str, ann: int = 252, rf: float = 0.0) -> list[str]:
    """CTEs tm_c, tm_d, tm_a and ``tm`` (one row of trading metrics)."""
    U = f"ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    sq = ann ** 0.5
    return [f"""
tm_c AS (SELECT {value} AS v, sum(coalesce({value}, 0.0)) OVER ({U}) AS cum, {order} FROM {src})""", f"""
tm_d AS (SELECT *, cum - max(cum) OVER ({U}) AS dd,
                CASE WHEN max(cum) OVER ({U}) <> 0 THEN (cum - max(cum) OVER ({U})) / max(cum) OVER ({U})
                     ELSE 0.0 END AS pdd FROM tm_c)""", """
tm_a AS (SELECT count(*) AS n, avg(v) AS mean, stddev_samp(v) AS sd, stddev_samp(CASE WHEN v < 0 THEN v END) AS dsd,
                min(dd) AS mdd, coalesce(sum(CASE WHEN v > 0 THEN v END), 0.0) AS gp,
                abs(coalesce(sum(CASE WHEN v < 0 THEN v END), 0.0)) AS gl, count_if(v > 0) AS nw,
                coalesce(avg(CASE WHEN v > 0 THEN v END), 0.0) AS aw,
                abs(coalesce(avg(CASE WHEN v < 0 THEN v END), 0.0)) AS al,
                sum(v) AS tot, max(cum) AS frm, avg(pdd * pdd) AS msq FROM tm_d)""", f"""
tm AS (SELECT n,
  CASE WHEN sd > 0 THEN (mean - {rf}) / sd * {sq!r} ELSE 0.0 END AS sharpe_ratio,
  CASE WHEN dsd > 0 THEN (mean - {rf}) / dsd * {sq!r} ELSE 0.0 END AS sortino_ratio,
  mdd AS max_drawdown,
  CASE WHEN gl > 0 THEN gp / gl ELSE 'inf'::DOUBLE END AS profit_factor,
  mean AS average_trade, nw / n AS win_rate,
  CASE WHEN abs(mdd) > 0 THEN mean * {ann} / abs(mdd) ELSE 0.0 END AS calmar_ratio,
  (nw / n) * aw - (1 - nw / n) * al AS expectancy,
  CASE WHEN abs(mdd) > 0 THEN tot / abs(mdd) ELSE 0.0 END AS recovery_factor,
  CASE WHEN gl > 0 THEN gp / gl ELSE 'inf'::DOUBLE END AS omega_ratio,
  CASE WHEN frm > 0 THEN sqrt(msq) ELSE 0.0 END AS ulcer_index
FROM tm_a)"""]


register("l2_trading_metrics", _with(T, PRED, *trading_sql("predictions", "actual_pnl", '"timestamp", trade_id'))
         + "SELECT * FROM tm")(
    lambda spark, sf: ev.trading_metrics(_preds(spark, sf), "actual_pnl", ORDER))


@register("l3_integrity_report", _with(*feature_store_ctes(), PRED, *FOLD_RESULTS_SQL) + """
SELECT (SELECT count(*) FROM trades) AS rows_trades, count(*) AS rows_predictions,
       count_if(trade_id IS NULL) AS null_trade_id, count_if(actual_pnl IS NULL) AS null_actual_pnl,
       count_if(predicted_pnl IS NULL) AS null_predicted_pnl,
       (SELECT count(*) FROM predictions p JOIN trades t ON p.trade_id = t.id) AS joined_rows,
       (SELECT count(*) FROM predictions p WHERE NOT EXISTS (SELECT 1 FROM trades t WHERE t.id = p.trade_id))
         AS orphan_predictions,
       (SELECT count(*) FROM macro_series) AS rows_macro_events, (SELECT count(*) FROM fs) AS rows_feature_store,
       (SELECT count(*) FROM fold_results) AS rows_walk_forward_results,
       (SELECT count(*) FROM trades) > 0 AND count(*) > 0 AND (SELECT count(*) FROM macro_series) > 0
         AND (SELECT count(*) FROM fs) > 0 AND (SELECT count(*) FROM fold_results) > 0
         AND (SELECT count(*) FROM predictions p JOIN trades t ON p.trade_id = t.id) > 0
         AND count_if(trade_id IS NULL) = 0 AND count_if(actual_pnl IS NULL) = 0
         AND count_if(predicted_pnl IS NULL) = 0
         AND (SELECT count(*) FROM predictions p WHERE NOT EXISTS (SELECT 1 FROM trades t WHERE t.id = p.trade_id)) = 0
         AS passed
FROM predictions""")
def _l3(spark, sf):
    t = _trades(spark, sf)
    events = macro.derive_events(fx.macro_from_orders(spark, sf))
    return ev.integrity_report(t, fx.predictions_from_trades(t), {
        "macro_events": events, "feature_store": _feature_store(spark, sf),
        "walk_forward_results": _fold_results(spark, sf)})


register("l4_prediction_checks", _with(T, PRED) + """
SELECT count(*) AS "rows", count_if(predicted_pnl IS NULL) AS null_predicted,
       count_if(actual_pnl IS NULL) AS null_actual, count_if(permutation_id IS NULL) AS null_permutation,
       (SELECT count(*) FROM (SELECT 1 FROM predictions GROUP BY walk_forward_fold, trade_id HAVING count(*) > 1))
         AS duplicate_keys,
       count(*) > 0 AND count_if(predicted_pnl IS NULL) = 0 AND count_if(actual_pnl IS NULL) = 0
         AND count_if(permutation_id IS NULL) = 0
         AND (SELECT count(*) FROM (SELECT 1 FROM predictions GROUP BY walk_forward_fold, trade_id
                                    HAVING count(*) > 1)) = 0 AS passed
FROM predictions""")(lambda spark, sf: ev.prediction_checks(_preds(spark, sf)))

_O = 'ORDER BY "timestamp", trade_id'
register("l5_baselines", _with(T, PRED, f"""
b AS (SELECT actual_pnl AS y,
        coalesce(lag(actual_pnl) OVER ({_O}), actual_pnl) AS previous_trade,
        coalesce(avg(actual_pnl) OVER ({_O} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), actual_pnl) AS rolling_mean,
        avg(actual_pnl) OVER () AS predict_mean, quantile_cont(actual_pnl, 0.5) OVER () AS predict_median
      FROM predictions)""", """
long AS (SELECT y, 'predict_mean' AS baseline, predict_mean AS pred FROM b
         UNION ALL SELECT y, 'predict_median', predict_median FROM b
         UNION ALL SELECT y, 'previous_trade', previous_trade FROM b
         UNION ALL SELECT y, 'rolling_mean', rolling_mean FROM b)""") + regression_sql(
    "long", "y", "pred", "baseline").replace("SELECT baseline, count(*) AS n, ", "SELECT baseline, "))(
    lambda spark, sf: ev.baseline_report(_preds(spark, sf)))

_UNIFORM = "(('0x' || substr(md5('42-{0}-' || trade_id::VARCHAR), 1, 12))::BIGINT + 0.5) / 281474976710656.0"
register("l5_random_baseline", _with(T, PRED, f"""
rnd AS (SELECT actual_pnl AS y, 'random' AS baseline, avg(actual_pnl) OVER () + stddev_pop(actual_pnl) OVER ()
               * sqrt(-2 * ln({_UNIFORM.format("r")})) * cos(2 * pi() * {_UNIFORM.format("a")}) AS pred
        FROM predictions)""") + regression_sql("rnd", "y", "pred", "baseline").replace(
    "SELECT baseline, count(*) AS n, ", "SELECT baseline, "))(
    lambda spark, sf: ev.baseline_report(_preds(spark, sf), include_random=True)
    .filter(F.col("baseline") == "random"))

# ---------------------------------------------------------------------------
# L6, L7 target audit; L8, L9 macro quality; L10 drift
# ---------------------------------------------------------------------------

register("l6_target_audit", _with(T, """
lp AS (SELECT pnl AS x, lag(pnl) OVER (ORDER BY "timestamp", id) AS px FROM trades)""", """
ac AS (SELECT CASE WHEN var_pop(x) > 0 AND var_pop(px) > 0 THEN corr(x, px) END AS r FROM lp
       WHERE x IS NOT NULL AND px IS NOT NULL)""") + """
SELECT avg(pnl) AS mean, stddev_samp(pnl) AS std, var_samp(pnl) AS variance, skewness(pnl) AS skewness,
       kurtosis(pnl) AS kurtosis, (SELECT r FROM ac) AS autocorrelation_lag1,
       CASE WHEN stddev_samp(pnl) > 0 THEN abs(avg(pnl)) / stddev_samp(pnl) ELSE 0.0 END AS signal_to_noise_ratio,
       CASE WHEN var_pop(pnl) * count(pnl) > 0 THEN 0.0 ELSE 1.0 END AS baseline_r2,
       CASE WHEN stddev_samp(pnl) > 0 THEN abs(avg(pnl)) / stddev_samp(pnl) ELSE 0.0 END < 0.05 AS advise_low_snr,
       abs(skewness(pnl)) > 2.0 AS advise_skewed,
       (SELECT r FROM ac) > 0.1 AS advise_autocorrelated
FROM trades""")(lambda spark, sf: ev.target_audit(_trades(spark, sf)))

_PAIRS_SQL = """
pairs AS (SELECT a.series_id AS series_a, b.series_id AS series_b, count(*) AS n,
                 CASE WHEN var_pop(a.value) > 0 AND var_pop(b.value) > 0 THEN corr(a.value, b.value) END AS corr
          FROM macro_series a JOIN macro_series b ON a.date = b.date AND a.series_id <> b.series_id
          WHERE a.value IS NOT NULL AND b.value IS NOT NULL GROUP BY 1, 2)"""

register("l9_series_correlation", _with(fx.macro_sql(daily=True), _PAIRS_SQL) + "SELECT * FROM pairs")(
    lambda spark, sf: (prepare_session(spark), ev.series_correlation(
        fx.macro_from_orders(spark, sf, daily=True)))[1])

register("l8_macro_quality", _with(fx.macro_sql(daily=True), _PAIRS_SQL) + """
SELECT s.series_id, min(date) AS start_date, max(date) AS end_date,
       avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) * 100.0 AS missing_pct, var_samp(value) AS variance,
       coalesce((SELECT string_agg(series_b, ',' ORDER BY series_b) FROM pairs p
                 WHERE p.series_a = s.series_id AND abs(p.corr) > 0.8), '') AS high_correlations
FROM macro_series s GROUP BY s.series_id""")(
    lambda spark, sf: (prepare_session(spark), ev.macro_quality(fx.macro_from_orders(spark, sf, daily=True)))[1])


_DRIFT_COLS = ["hour_of_day", "day_of_week", "week_of_month", "month", "quarter", "minutes_after_open",
               "minutes_before_close", "rolling_pnl_5", "rolling_pnl_20", "rolling_win_rate",
               "rolling_avg_quantity", "rolling_trade_frequency", "rolling_volatility", "rolling_drawdown",
               "days_since_release", "days_until_next_release", "release_frequency", "rolling_mean",
               "rolling_std", "rolling_min", "rolling_max", "rolling_median", "rolling_percent_change",
               "rolling_zscore", "macro_rolling_volatility", "macro_rolling_variance", "macro_rolling_percentile",
               "macro_ewma", "rolling_skewness", "rolling_kurtosis", "expanding_mean", "expanding_std",
               "macro_momentum", "macro_acceleration", "macro_regime", "yield_curve_spread", "inflation_momentum",
               "lag_1", "lag_3", "lag_6", "lag_12", "holding_time", "threshold"]


@register("l10_feature_drift", _with(*feature_store_ctes(), f"""
j AS (SELECT fs.*, epoch_us(t."timestamp") AS tus FROM fs JOIN trades t ON fs.trade_id = t.id)""", """
mid AS (SELECT quantile_cont(tus, 0.5) AS m FROM j)""", f"""
long AS (UNPIVOT (SELECT tus < (SELECT m FROM mid) AS first_half,
                         {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _DRIFT_COLS)} FROM j)
         ON {", ".join(_DRIFT_COLS)} INTO NAME feature VALUE v)""") + """
SELECT feature, avg(v) FILTER (WHERE first_half) AS first_half_mean,
       CASE WHEN min(v) FILTER (WHERE first_half) = max(v) FILTER (WHERE first_half) AND count(v) FILTER (WHERE first_half) > 1 THEN 0.0 ELSE stddev_samp(v) FILTER (WHERE first_half) END AS first_half_std,
       avg(v) FILTER (WHERE NOT first_half) AS second_half_mean,
       CASE WHEN min(v) FILTER (WHERE NOT first_half) = max(v) FILTER (WHERE NOT first_half) AND count(v) FILTER (WHERE NOT first_half) > 1 THEN 0.0 ELSE stddev_samp(v) FILTER (WHERE NOT first_half) END AS second_half_std,
       CASE WHEN min(v) FILTER (WHERE first_half) < max(v) FILTER (WHERE first_half)
                 AND stddev_samp(v) FILTER (WHERE first_half) > 0
            THEN abs(avg(v) FILTER (WHERE first_half) - avg(v) FILTER (WHERE NOT first_half))
                 / (stddev_samp(v) FILTER (WHERE first_half) + 1e-9) ELSE 0.0 END AS drift_score
FROM long GROUP BY feature""")
def _l10(spark, sf):
    f = _feature_store(spark, sf)
    return ev.feature_drift(f, _trades(spark, sf))


# ---------------------------------------------------------------------------
# L12-L25 on the fixture predictions
# ---------------------------------------------------------------------------

register("l12_slot_heatmap", _with(T, PRED, """
g AS (SELECT CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week, CAST(hour("timestamp") AS INTEGER) AS hour_of_day,
             permutation_id, avg(predicted_pnl) AS predicted_pnl FROM predictions GROUP BY ALL)""", """
best AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY day_of_week, hour_of_day
                                                    ORDER BY predicted_pnl DESC NULLS LAST, permutation_id) = 1)""",
                                         """
codes AS (SELECT permutation_id, 'P' || CAST(dense_rank() OVER (ORDER BY permutation_id) AS VARCHAR) AS code
          FROM (SELECT DISTINCT permutation_id FROM best))""") + """
SELECT day_of_week, hour_of_day, permutation_id, predicted_pnl, code FROM best JOIN codes USING (permutation_id)""")(
    lambda spark, sf: ev.slot_heatmap(_preds(spark, sf)))

_SLOT_PIVOT = ", ".join([f"max(CASE WHEN hour_of_day = {h} THEN permutation_id END) AS p{h:02d}" for h in range(24)]
                         + [f"max(CASE WHEN hour_of_day = {h} THEN predicted_pnl END) AS v{h:02d}" for h in range(24)])
register("l12_slot_pivots", _with(T, PRED, """
g AS (SELECT CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week, CAST(hour("timestamp") AS INTEGER) AS hour_of_day,
             permutation_id, avg(predicted_pnl) AS predicted_pnl FROM predictions GROUP BY ALL)""", """
best AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY day_of_week, hour_of_day
                                                    ORDER BY predicted_pnl DESC NULLS LAST, permutation_id) = 1)""") + f"""
SELECT day_of_week, {_SLOT_PIVOT} FROM best GROUP BY day_of_week""")(
    lambda spark, sf: ev.slot_pivots(ev.slot_heatmap(_preds(spark, sf))))

_BEST_TS = """
best_ts AS (SELECT arg_max(trade_id, (predicted_pnl, -trade_id)) AS trade_id, "timestamp",
                   max(predicted_pnl) AS predicted_pnl
            FROM predictions WHERE predicted_pnl IS NOT NULL GROUP BY "timestamp")"""
# Every 7th prediction is NaN: it counts as missing.
_NAN = "nanp AS (SELECT * REPLACE (CASE WHEN trade_id % 7 = 0 THEN 'NaN'::DOUBLE ELSE predicted_pnl END AS predicted_pnl) FROM predictions)"


def _nan_preds(spark, sf):
    return _preds(spark, sf).withColumn("predicted_pnl", F.when(F.col("trade_id") % 7 == 0, F.lit(float("nan")))
                                        .otherwise(F.col("predicted_pnl")))


register("l12_slot_heatmap_nan", _with(T, PRED, _NAN, """
g AS (SELECT CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week, CAST(hour("timestamp") AS INTEGER) AS hour_of_day,
             permutation_id, avg(CASE WHEN NOT isnan(predicted_pnl) THEN predicted_pnl END) AS predicted_pnl
      FROM nanp GROUP BY ALL)""", """
best AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY day_of_week, hour_of_day
                                                    ORDER BY predicted_pnl DESC NULLS LAST, permutation_id) = 1)""",
                                       """
codes AS (SELECT permutation_id, 'P' || CAST(dense_rank() OVER (ORDER BY permutation_id) AS VARCHAR) AS code
          FROM (SELECT DISTINCT permutation_id FROM best))""") + """
SELECT day_of_week, hour_of_day, permutation_id, predicted_pnl, code FROM best JOIN codes USING (permutation_id)""")(
    lambda spark, sf: ev.slot_heatmap(_nan_preds(spark, sf)))

register("l13_best_prediction_nan", _with(T, PRED, _NAN) + """
SELECT arg_max(trade_id, (predicted_pnl, -trade_id)) AS trade_id, "timestamp", max(predicted_pnl) AS predicted_pnl
FROM nanp WHERE predicted_pnl IS NOT NULL AND NOT isnan(predicted_pnl) GROUP BY nanp."timestamp" """)(
    lambda spark, sf: ev.best_prediction_per_timestamp(_nan_preds(spark, sf)))

_PORT = """
port AS (SELECT b.trade_id, b."timestamp", b.predicted_pnl, t.pnl AS realized_pnl, t.permutation_id
         FROM best_ts b JOIN trades t ON b.trade_id = t.id)"""

register("l13_best_prediction_per_timestamp", _with(T, PRED, _BEST_TS) + "SELECT * FROM best_ts")(
    lambda spark, sf: ev.best_prediction_per_timestamp(_preds(spark, sf)))

register("l14_l15_equity_curve", _with(T, PRED, _BEST_TS, _PORT, f"""
base AS (SELECT "timestamp", sum(pnl) AS baseline_pnl FROM trades WHERE permutation_id = '{BASELINE_PERM}'
         GROUP BY 1)""") + """
SELECT p."timestamp", p.trade_id, p.predicted_pnl, p.realized_pnl,
       sum(p.realized_pnl) OVER (ORDER BY p."timestamp" ROWS UNBOUNDED PRECEDING) AS cumulative_pnl,
       coalesce(b.baseline_pnl, 0.0) AS baseline_pnl,
       sum(coalesce(b.baseline_pnl, 0.0)) OVER (ORDER BY p."timestamp" ROWS UNBOUNDED PRECEDING)
         AS baseline_cumulative_pnl
FROM port p LEFT JOIN base b USING ("timestamp")""")(
    lambda spark, sf: (lambda t: ev.equity_curve(fx.predictions_from_trades(t), t,
                                                 BASELINE_PERM))(_trades(spark, sf)))


def _l16_sql() -> str:
    m = [c.replace("tm_", "mt_").replace("FROM tm_", "FROM mt_") for c in trading_sql("port", "realized_pnl", '"timestamp"')]
    m = [c.replace("tm AS (", "mtm AS (") for c in m]
    b = [c.replace("tm_", "bt_") for c in trading_sql("bport", "baseline_pnl", '"timestamp"')]
    b = [c.replace("tm AS (", "btm AS (") for c in b]
    return _with(T, PRED, _BEST_TS, _PORT, f"""
base AS (SELECT "timestamp", sum(pnl) AS baseline_pnl FROM trades WHERE permutation_id = '{BASELINE_PERM}'
         GROUP BY 1)""", """
bport AS (SELECT p."timestamp", coalesce(b.baseline_pnl, 0.0) AS baseline_pnl FROM port p LEFT JOIN base b
          USING ("timestamp"))""", *m, *b) + """
SELECT 'model' AS portfolio, * FROM mtm UNION ALL SELECT 'baseline' AS portfolio, * FROM btm"""


register("l16_portfolio_comparison", _l16_sql())(
    lambda spark, sf: (lambda t: ev.portfolio_comparison(fx.predictions_from_trades(t), t,
                                                         BASELINE_PERM))(_trades(spark, sf)))

register("l27_trading_findings", "WITH c AS (" + _l16_sql() + """)
SELECT max(CASE WHEN portfolio = 'model' THEN sharpe_ratio END) AS model_sharpe,
       max(CASE WHEN portfolio = 'baseline' THEN sharpe_ratio END) AS baseline_sharpe,
       max(CASE WHEN portfolio = 'model' THEN profit_factor END) AS model_profit_factor,
       max(CASE WHEN portfolio = 'model' THEN sharpe_ratio END)
         > max(CASE WHEN portfolio = 'baseline' THEN sharpe_ratio END) AS adds_value,
       max(CASE WHEN portfolio = 'model' THEN profit_factor END) > 1.0 AS profitable FROM c""")(
    lambda spark, sf: (lambda t: ev.trading_findings(ev.portfolio_comparison(
        fx.predictions_from_trades(t), t, BASELINE_PERM)))(_trades(spark, sf)))

_RES = """
res AS (SELECT p.trade_id, p."timestamp", p.permutation_id, p.predicted_pnl, p.walk_forward_fold, p.experiment_id,
               t.pnl AS actual_pnl, p.predicted_pnl - t.pnl AS residual, abs(p.predicted_pnl - t.pnl) AS abs_error
        FROM predictions p JOIN trades t ON p.trade_id = t.id)"""


def _res(spark, sf):
    t = _trades(spark, sf)
    return ev.residuals(fx.predictions_from_trades(t), t)


register("l17_residuals", _with(T, PRED, _RES) + "SELECT * FROM res")(_res)
register("l18_worst_predictions", _with(T, PRED, _RES) + "SELECT * FROM res ORDER BY abs_error DESC, trade_id LIMIT 10")(
    lambda spark, sf: ev.worst_predictions(_res(spark, sf)))
register("l19_permutation_performance", _with(T, PRED, _RES) + """
SELECT permutation_id, sum(actual_pnl) AS actual_pnl, avg(abs_error) AS abs_error FROM res GROUP BY 1""")(
    lambda spark, sf: ev.permutation_performance(_res(spark, sf)))

register("l20_residual_histogram", _with(T, PRED, _RES, """
hb AS (SELECT min(residual) AS lo, max(residual) AS hi FROM res)""") + """
SELECT CAST(CASE WHEN hi > lo THEN least(floor((residual - lo) / ((hi - lo) / 50)), 49) ELSE 0 END AS INTEGER) AS bin,
       lo + CAST(CASE WHEN hi > lo THEN least(floor((residual - lo) / ((hi - lo) / 50)), 49) ELSE 0 END AS INTEGER)
            * (hi - lo) / 50 AS lower,
       lo + (CAST(CASE WHEN hi > lo THEN least(floor((residual - lo) / ((hi - lo) / 50)), 49) ELSE 0 END AS INTEGER) + 1)
            * (hi - lo) / 50 AS upper,
       count(*) AS count
FROM res, hb WHERE residual IS NOT NULL GROUP BY ALL""")(
    lambda spark, sf: ev.histogram(_res(spark, sf), "residual", 50))

register("l23_durbin_watson", _with(T, PRED, _RES, """
e AS (SELECT actual_pnl - predicted_pnl AS e,
             lag(actual_pnl - predicted_pnl) OVER (ORDER BY "timestamp", trade_id) AS pe FROM res)""") + """
SELECT CASE WHEN sum(e * e) <> 0 THEN sum((e - pe) * (e - pe)) / sum(e * e) END AS durbin_watson FROM e""")(
    lambda spark, sf: ev.durbin_watson(_res(spark, sf)))

register("l24_jarque_bera", _with(T, PRED, _RES, """
m AS (SELECT count(*) AS n, avg(actual_pnl - predicted_pnl) AS mu FROM res)""", """
mo AS (SELECT avg(power(actual_pnl - predicted_pnl - mu, 2)) AS m2, avg(power(actual_pnl - predicted_pnl - mu, 3)) AS m3,
              avg(power(actual_pnl - predicted_pnl - mu, 4)) AS m4 FROM res, m)""") + """
SELECT n, n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4.0) AS jb_statistic,
       exp(-(n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4.0)) / 2.0) AS jb_p_value
FROM m, mo""")(lambda spark, sf: ev.jarque_bera(_res(spark, sf).withColumn(
    "e", F.col("actual_pnl") - F.col("predicted_pnl")), "e"))

register("l25_residual_tests")(lambda spark, sf: ev.residual_tests(_res(spark, sf)))
