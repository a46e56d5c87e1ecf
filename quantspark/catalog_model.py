"""Registered model-matrix, training and recommendation queries (H, J, K)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.catalog import _feature_store, _trades, _with, feature_store_ctes, register
from quantspark.catalog_eval import _DRIFT_COLS
from quantspark.operators.ordered import POS, with_position
from quantspark.plans import boosting
from quantspark.plans import model as mdl
from quantspark.plans.evaluate import regression_metrics
from quantspark.plans import recommend as rec
from quantspark.plans.folds import cv_block_column
from quantspark.session import stored
from quantspark.sources import fixtures as fx

FP = fx.fixture_params()
MATRIX_FEATURES = sorted(_DRIFT_COLS + ["market_session_encoded"])
PROFILE_VALUES = [c for c in MATRIX_FEATURES if c not in rec.SLOT_KEYS]
_SESSION_CASE = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mdl.SESSION_CODES.items())

MATRIX_SQL = f"""
m AS (SELECT fs.trade_id, fs.permutation_id, fs.market_session, t."timestamp" AS trade_timestamp,
             coalesce(fs.pnl, 0.0) AS pnl,
             CAST(coalesce(CASE fs.market_session {_SESSION_CASE} END, 3) AS INTEGER) AS market_session_encoded,
             {", ".join(f"coalesce(fs.{c}, 0) AS {c}" for c in _DRIFT_COLS)}
      FROM fs JOIN trades t ON fs.trade_id = t.id)"""


def _matrix(spark, sf):
    return mdl.prepare(_feature_store(spark, sf), _trades(spark, sf))


def _fit_matrix(spark, sf):
    """The columns of the matrix that fitting and scoring read, stored once: models take many passes over it."""
    m = _matrix(spark, sf)
    return stored(m.select("trade_id", "trade_timestamp", "pnl", *mdl.feature_columns(m)), "matrix")


register("h_model_matrix", _with(*feature_store_ctes(), MATRIX_SQL) + f"""
SELECT trade_id, trade_timestamp, permutation_id, pnl, {", ".join(MATRIX_FEATURES)} FROM m""")(
    lambda spark, sf: _matrix(spark, sf).select("trade_id", "trade_timestamp", "permutation_id", "pnl",
                                                *MATRIX_FEATURES))

_PROFILE_SQL = [f"""
perms AS (SELECT permutation_id,
                 min(trade_timestamp) AS first_seen
          FROM m WHERE permutation_id IS NOT NULL GROUP BY permutation_id)""", """
slots AS (SELECT p.permutation_id, p.first_seen, CAST(s // 24 AS INTEGER) AS day_of_week,
                 CAST(s % 24 AS INTEGER) AS hour_of_day FROM perms p, range(0, 168) r(s))""", f"""
g AS (SELECT day_of_week, hour_of_day, true AS present, {", ".join(f"avg({c}) AS g_{c}" for c in PROFILE_VALUES)}
      FROM m GROUP BY 1, 2)""", f"""
pp AS (SELECT permutation_id, day_of_week, hour_of_day, {", ".join(f"avg({c}) AS p_{c}" for c in PROFILE_VALUES)}
       FROM m WHERE permutation_id IS NOT NULL GROUP BY 1, 2, 3)""", f"""
px AS (SELECT s.permutation_id, s.first_seen, s.day_of_week, s.hour_of_day,
              {", ".join(f"CASE WHEN g.present THEN coalesce(pp.p_{c}, g.g_{c}) END AS f_{c}" for c in PROFILE_VALUES)}
       FROM slots s LEFT JOIN g USING (day_of_week, hour_of_day)
       LEFT JOIN pp USING (permutation_id, day_of_week, hour_of_day))""", f"""
profiles AS (SELECT permutation_id, first_seen, day_of_week, hour_of_day,
                    {", ".join(f"coalesce(f_{c}, avg(f_{c}) OVER (PARTITION BY permutation_id), 0.0) AS {c}"
                               for c in PROFILE_VALUES)}
             FROM px)"""]


def _profiles(spark, sf):
    m = _matrix(spark, sf)
    return rec.profiles(m, mdl.feature_columns(m))


register("k1_k3_permutation_profiles", _with(*feature_store_ctes(), MATRIX_SQL, *_PROFILE_SQL)
         + "SELECT * FROM profiles")(_profiles)


def _walk_forward(spark, sf):
    m = _matrix(spark, sf)
    res = mdl.train_walk_forward(m, FP, models=("linear_regression", "ridge", "lasso"),
                                 experiment_id=fx.FIXTURE_EXPERIMENT)
    return res.predictions


register("j_walk_forward_predictions")(_walk_forward)


def _recommend(spark, sf):
    m = _matrix(spark, sf)
    feats = mdl.feature_columns(m)
    model = mdl.fit_linear("linear_regression", {}, m, feats)
    prof = rec.profiles(m, feats)
    best = rec.best_per_slot(rec.score_grid(prof, model.transform))
    return rec.recommendation_matrix(best)


register("k4_k7_recommendation_matrix")(_recommend)


def _best_slots(spark, sf):
    m = _matrix(spark, sf)
    feats = mdl.feature_columns(m)
    model = mdl.fit_linear("linear_regression", {}, m, feats)
    return rec.best_per_slot(rec.score_grid(rec.profiles(m, feats), model.transform))


register("k6_best_permutation_per_slot")(_best_slots)


# K6 / K7 with a transparent scorer (the slot profile's rolling_pnl_20), so the
# best-per-slot and matrix logic is checkable in SQL without a fitted model.
def _score_by_rolling_pnl(prof):
    return prof.withColumn("prediction", F.col("rolling_pnl_20"))


def _k6_transparent(spark, sf):
    m = _matrix(spark, sf)
    return rec.best_per_slot(rec.score_grid(rec.profiles(m, mdl.feature_columns(m)), _score_by_rolling_pnl))


_K6_SQL = _with(*feature_store_ctes(), MATRIX_SQL, *_PROFILE_SQL, """
best AS (SELECT day_of_week, hour_of_day, permutation_id AS best_permutation, rolling_pnl_20 AS predicted_pnl
         FROM profiles WHERE rolling_pnl_20 IS NOT NULL AND NOT isnan(rolling_pnl_20)
         QUALIFY row_number() OVER (PARTITION BY day_of_week, hour_of_day
                                    ORDER BY rolling_pnl_20 DESC, first_seen, permutation_id) = 1)""")
register("k6_best_slot_transparent_scorer", _K6_SQL + "SELECT * FROM best")(_k6_transparent)

_DAYS = ", ".join(f"({i}, '{d}')" for i, d in enumerate(rec.DAYS))
register("k7_matrix_transparent_scorer", _K6_SQL.rstrip() + f""",
days AS (SELECT * FROM (VALUES {_DAYS}) t(day_of_week, day))
SELECT d.day, CAST(d.day_of_week AS INTEGER) AS day_of_week,
       {", ".join(f'max(CASE WHEN b.hour_of_day = {h} THEN b.best_permutation END) AS "{h:02d}:00"' for h in range(24))}
FROM days d LEFT JOIN best b ON b.day_of_week = d.day_of_week GROUP BY d.day, d.day_of_week""")(
    lambda spark, sf: rec.recommendation_matrix(_k6_transparent(spark, sf)))


# J2-J5 on all features: a solution has no violated optimality condition, whatever its coefficients.
_LINEAR = {"linear_regression": {}, "ridge": {"alpha": 1.0}, "lasso": {"alpha": 0.1},
           "elasticnet": {"alpha": 0.1, "l1_ratio": 0.5}}


def _optimality(spark, sf):
    m = _fit_matrix(spark, sf)
    parts = [mdl.optimality(mdl.fit_linear(name, cfg, m, MATRIX_FEATURES), m) for name, cfg in _LINEAR.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("violation", F.round("violation", 5))


register("j1_j5_optimality_all_features", "SELECT model, feature, 0.0::DOUBLE AS violation FROM (VALUES "
         + ", ".join(f"('{n}')" for n in _LINEAR) + ") a(model), (VALUES "
         + ", ".join(f"('{c}')" for c in MATRIX_FEATURES) + ") b(feature)")(_optimality)

# Fitted trees have no closed form; rows only.
_TREES = {"random_forest": {"n_estimators": 10, "max_depth": 5}, "xgboost": {"n_estimators": 8, "max_depth": 3},
          "lightgbm": {"n_estimators": 8, "max_depth": 3}, "catboost": {"iterations": 8, "depth": 3}}


def _tree_models(spark, sf):
    """Every tree model on the whole matrix, with its regression metrics on the same rows."""
    m = _matrix(spark, sf).persist()
    ready = boosting.binned(m, MATRIX_FEATURES, "pnl")     # the boosting presets fit on the same rows
    parts = [regression_metrics(mdl.fit(name, cfg, m, MATRIX_FEATURES, ready=ready).transform(m), "pnl", "prediction")
             .withColumn("model", F.lit(name)) for name, cfg in _TREES.items()]
    return reduce(DataFrame.unionByName, parts)


register("j6_j7_tree_models")(_tree_models)


def _stacked(spark, sf):
    """Walk-forward with the stack of the linear models; the validation scores of all, fold by fold."""
    import dataclasses
    return mdl.train_walk_forward(_matrix(spark, sf), dataclasses.replace(FP, enable_stacking=True),
                                  models=("linear_regression", "ridge"), grids={"ridge": {"alpha": [1.0]}}).scores


register("j10_stacking_scores")(_stacked)


def _stacked_trees(spark, sf):
    """J10 over trees and linear models: the stack of ridge, boosting and a forest on the whole matrix with the
    trainer's validation blocks; out-of-fold error, weights and intercept."""
    m = with_position(_matrix(spark, sf), ["trade_timestamp", "trade_id"]).persist()
    n = m.count()
    cv = m.withColumn("cv_block", cv_block_column(POS, 0, n))
    mae, model = mdl.stack(cv, MATRIX_FEATURES, "pnl", [
        ("ridge", {"alpha": 1.0}), ("lightgbm", {"n_estimators": 2, "num_leaves": 5, "max_depth": 3}),
        ("random_forest", {"n_estimators": 3, "max_depth": 3})])
    bases, weights, intercept = model.model
    return spark.createDataFrame([(b.name, float(w), float(mae), float(intercept)) for b, w in zip(bases, weights)],
                                 "model string, weight double, validation_mae double, intercept double")


register("j10_stack_over_trees")(_stacked_trees)


def _cv_blocks(spark, sf):
    """I4 as training uses it: rows and positions of every validation block of the whole matrix."""
    t = with_position(_trades(spark, sf).select("id", "timestamp"), ["timestamp", "id"])
    n = t.count()
    return t.withColumn("cv_block", cv_block_column(POS, 0, n)).groupBy("cv_block").agg(
        F.count(F.lit(1)).alias("n"), F.min(POS).alias("first_position"), F.max(POS).alias("last_position"),
        F.sum("id").alias("id_sum"))


register("i4_cv_block_column", _with(fx.TRADES_EVENTS_SQL) + """,
p AS (SELECT id, row_number() OVER (ORDER BY "timestamp", id) - 1 AS p, count(*) OVER () AS n FROM trades),
b AS (SELECT id, p, CASE WHEN n // 4 = 0 OR p < n - 3 * (n // 4) THEN 0
                         ELSE least((p - n + 3 * (n // 4)) // (n // 4) + 1, 3) END AS cv_block FROM p)
SELECT CAST(cv_block AS INTEGER) AS cv_block, count(*) AS n, min(p) AS first_position, max(p) AS last_position,
       CAST(sum(id) AS BIGINT) AS id_sum FROM b GROUP BY 1""")(_cv_blocks)
