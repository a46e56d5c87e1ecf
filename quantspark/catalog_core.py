"""Registered queries that check the model core, the stores and small diagnostics in SQL.

With one feature every linear model has a closed form, with two the
collinearity figures have; the partial autocorrelations are a recursion over
the autocorrelations; stores are written below the shared checkpoint folder and
read back.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from quantspark.catalog import ORACLE, _macro, _trades, _with, feature_store_ctes, register
from quantspark.catalog_diag import _ACF_SQL, _LAGS
from quantspark.catalog_model import MATRIX_SQL, _matrix
from quantspark.functions.linalg import block_moments, solve
from quantspark.plans import diagnose as dg
from quantspark.plans import features, macro
from quantspark.plans import model as mdl
from quantspark.session import prepare_session, scratch_folder
from quantspark.sources import fixtures as fx
from quantspark.sources import tables as tb

X, Y = "rolling_pnl_20", "pnl"
# (model, alpha, l1_ratio) of the one-feature fits.
FITS = [("linear_regression", 0.0, 0.0), ("ridge", 0.1, 0.0), ("ridge", 10.0, 0.0), ("lasso", 0.01, 1.0),
        ("lasso", 1.0, 1.0), ("elasticnet", 0.1, 0.2), ("elasticnet", 1.0, 0.8)]


def _fits(spark, sf):
    m = _matrix(spark, sf)
    shift = mdl._shift(m, [X], Y)
    moments = block_moments(m, [X], Y, None, shift)[None]
    rows = []
    for name, alpha, ratio in FITS:
        s = solve(moments, name, {"alpha": alpha, "l1_ratio": ratio}, np.array([shift[X]]), shift[Y])
        rows.append((name, alpha, ratio, float(s.mean[0]), float(s.std[0]), float(s.w[0]), float(s.intercept)))
    return spark.createDataFrame(rows, "model string, alpha double, l1_ratio double, mean double, std double, "
                                       "slope double, intercept double")


_FIT_VALUES = ", ".join(f"('{n}', CAST({a} AS DOUBLE), CAST({r} AS DOUBLE))" for n, a, r in FITS)
register("j1_j5_one_feature_fits", _with(*feature_store_ctes(), MATRIX_SQL, f"""
s AS (SELECT count(*) AS n, avg({X}) AS mx, avg({Y}) AS my, stddev_pop({X}) AS sd, covar_pop({X}, {Y}) AS c FROM m)""", f"""
f AS (SELECT * FROM (VALUES {_FIT_VALUES}) t(model, alpha, l1_ratio))""", """
b AS (SELECT f.*, mx, my, sd,
             CASE model WHEN 'linear_regression' THEN c / sd
                        WHEN 'ridge' THEN n * (c / sd) / (n + alpha)
                        ELSE sign(c) * greatest(abs(c / sd) - alpha * l1_ratio, 0) / (1 + alpha * (1 - l1_ratio)) END AS beta
      FROM f, s)""") + """
SELECT model, alpha, l1_ratio, mx AS mean, sd AS std, beta / sd AS slope, my - beta / sd * mx AS intercept FROM b""")(_fits)


def _attribution(spark, sf):
    m = _matrix(spark, sf)
    model = mdl.fit_linear("linear_regression", {}, m, [X])
    return mdl.linear_attribution(model, m)


register("j18_one_feature_attribution", _with(*feature_store_ctes(), MATRIX_SQL, f"""
s AS (SELECT regr_slope({Y}, {X}) AS w, avg({X}) AS mx FROM m)""") + f"""
SELECT '{X}' AS feature, avg(abs((SELECT w FROM s) * ({X} - (SELECT mx FROM s)))) AS value FROM m""")(_attribution)


def _score(spark, sf):
    """A fitted linear model scores every row of the matrix in one native expression."""
    m = _matrix(spark, sf)
    model = mdl.fit_linear("linear_regression", {}, m, [X])
    return model.transform(m, "predicted_pnl").select("trade_id", "predicted_pnl")


register("j12_k5_linear_scores", _with(*feature_store_ctes(), MATRIX_SQL) + f"""
SELECT trade_id, (SELECT regr_intercept({Y}, {X}) FROM m) + (SELECT regr_slope({Y}, {X}) FROM m) * {X} AS predicted_pnl
FROM m""")(_score)

A, B = "rolling_pnl_5", "rolling_volatility"


def _two(spark, sf):
    m = _matrix(spark, sf)
    summary, _, vif, _ = dg.collinearity(m, [A, B])
    one = spark.createDataFrame([(float(summary["condition_number"]), int(summary["rank"]))],
                                "condition_number double, rank int")
    return vif.join(one, how="inner", on=F.lit(True))      # one-row frame


register("m3_m5_two_features", _with(*feature_store_ctes(), MATRIX_SQL, f"""
r AS (SELECT corr({A}, {B}) AS r FROM m)""") + f"""
SELECT feature, 1 / (1 - r * r) AS vif, sqrt((1 + abs(r)) / (1 - abs(r))) AS condition_number, CAST(2 AS INTEGER) AS rank
FROM r, (VALUES ('{A}'), ('{B}')) t(feature)""")(_two)

register("m15_pacf_recursion", "WITH RECURSIVE a AS (" + _ACF_SQL + f"""),
r AS (SELECT list(acf ORDER BY lag) AS r FROM a),
d AS (
  SELECT 1 AS k, [r[2]] AS phi FROM r
  UNION ALL
  SELECT k + 1, list_concat([phi[j] - x * phi[k + 1 - j] FOR j IN range(1, k + 1)], [x]) FROM (
    SELECT k, phi, (r[k + 2] - list_sum([phi[j] * r[k + 2 - j] FOR j IN range(1, k + 1)]))
                   / (1 - list_sum([phi[j] * r[j + 1] FOR j IN range(1, k + 1)])) AS x
    FROM d, r WHERE k < {_LAGS}))
SELECT CAST(0 AS INTEGER) AS lag, 1.0::DOUBLE AS pacf UNION ALL SELECT CAST(k AS INTEGER), phi[k] FROM d""")(
    lambda spark, sf: dg.pacf(_trades(spark, sf), "pnl", ("timestamp", "id"), _LAGS))

ORACLE["m15_pacf"] = ORACLE["m15_pacf_recursion"]          # the same figures, registered under both names

# ---------------------------------------------------------------------------
# A: stores, written below the shared folder and read back
# ---------------------------------------------------------------------------


@register("a1_trades_csv_round_trip", _with(fx.TRADES_EVENTS_SQL) + "SELECT * FROM trades")
def _a1(spark, sf):
    path = scratch_folder(spark, "trades-csv")
    t = _trades(spark, sf)
    t = t.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    # One folder, files of two column orders.
    t.filter("id % 2 = 0").write.option("header", True).csv(path)
    t.filter("id % 2 = 1").select(*reversed(t.columns)).write.mode("append").option("header", True).csv(path)
    return tb.read_trades_csv(spark, path, mixed_headers=True)


@register("a4_a7_store_round_trip", _with(fx.TRADES_EVENTS_SQL, fx.macro_sql()) + """
SELECT 'trades' AS "table", count(*) AS "rows", sum(pnl) AS total FROM trades
UNION ALL SELECT 'macro_series', count(*), sum(value) FROM macro_series
UNION ALL SELECT 'macro_events', 2 * count(*), 2 * sum(value) FROM macro_series
UNION ALL SELECT 'predictions', 0, NULL UNION ALL SELECT 'walk_forward_results', 0, NULL
UNION ALL SELECT 'feature_store', 0, NULL UNION ALL SELECT 'experiments', 1, 42""")
def _a4(spark, sf):
    """Create all tables, overwrite, append twice, insert one record, read everything back."""
    import datetime as dt
    root = scratch_folder(spark, "store")
    tb.initialize_schema(spark, root)
    series = _macro(spark, sf)
    tb.write_table(_trades(spark, sf), root, "trades", "overwrite")
    tb.write_table(series, root, "macro_series", "replace")
    for _ in range(2):
        tb.write_table(macro.derive_events(series), root, "macro_events", "append")
    tb.append_rows(spark, root, "experiments", [("e", "ridge", {"tuner": "grid"}, "trades", "2.0", "macro", 3, ["DGS2"],
                                                None, 42, dt.datetime(2024, 1, 1))])
    value = {"trades": "pnl", "macro_series": "value", "macro_events": "actual", "experiments": "random_seed",
             "predictions": "predicted_pnl", "walk_forward_results": "mae", "feature_store": "pnl"}
    out = None
    for name, c in value.items():
        part = tb.read_table(spark, root, name).agg(F.count(F.lit(1)).alias("rows"),
                                                    F.sum(F.col(c).cast("double")).alias("total"))
        part = part.select(F.lit(name).alias("table"), "rows", "total")
        out = part if out is None else out.unionByName(part)
    return out


@register("a5_refresh_from_itself", _with(fx.TRADES_EVENTS_SQL) + """
SELECT 'refreshed' AS step, count(*) AS "rows", sum(pnl) AS total FROM trades WHERE pnl > 0
UNION ALL SELECT 'updated', count(*), sum(CASE WHEN direction = 'BUY' THEN 0 ELSE pnl END) FROM trades WHERE pnl > 0
UNION ALL SELECT 'deleted', count(*), sum(pnl) FROM trades WHERE pnl > 0 AND direction <> 'BUY'""")
def _a5(spark, sf):
    """A table refreshed from a filtered read of itself, then rows updated and deleted in place."""
    root = scratch_folder(spark, "refresh")
    tb.write_table(_trades(spark, sf), root, "trades", "overwrite")
    tb.write_table(tb.read_table(spark, root, "trades").filter("pnl > 0"), root, "trades", "overwrite")
    total = [F.count(F.lit(1)).alias("rows"), F.sum("pnl").alias("total")]
    steps = [("refreshed", tb.read_table(spark, root, "trades").agg(*total).first())]
    tb.rewrite_rows(spark, root, "trades", F.col("direction") == "BUY", {"pnl": F.lit(0.0)})
    steps.append(("updated", tb.read_table(spark, root, "trades").agg(*total).first()))
    tb.rewrite_rows(spark, root, "trades", F.col("direction") == "BUY")
    steps.append(("deleted", tb.read_table(spark, root, "trades").agg(*total).first()))
    return spark.createDataFrame([(n, r["rows"], r["total"]) for n, r in steps], "step string, rows long, total double")


@register("a9_macro_csv_round_trip", _with(fx.macro_sql(daily=True)) + """
SELECT series_id, date, avg(value) AS value, date + INTERVAL 30 DAY + INTERVAL 510 MINUTE AS release_date, 'monthly' AS frequency,
       'FRED' AS source FROM macro_series WHERE series_id = 'DGS2' GROUP BY series_id, date""")
def _a9(spark, sf):
    """A9 with B1-B4: one two-column file of a series, '.' for missing, read and normalised."""
    prepare_session(spark)
    path = scratch_folder(spark, "macro-csv")
    one = fx.macro_from_orders(spark, sf, daily=True).filter(F.col("series_id") == "DGS2").groupBy("date").agg(
        F.avg("value").alias("value"))
    gap = spark.range(1).select(F.lit("1990-01-01").cast("date").alias("date"), F.lit(None).cast("double").alias("value"))
    one.unionByName(gap).write.option("header", True).option("nullValue", ".").csv(path)
    return tb.read_macro_csv(spark, path, "DGS2")


@register("a10_report_round_trip", _with(fx.TRADES_EVENTS_SQL) + """
SELECT permutation_id, count(*) AS n, sum(pnl) AS pnl FROM trades GROUP BY 1""")
def _a10(spark, sf):
    """A10: a report written as JSON and read back."""
    path = scratch_folder(spark, "report")
    rep = _trades(spark, sf).groupBy("permutation_id").agg(F.count(F.lit(1)).alias("n"), F.sum("pnl").alias("pnl"))
    tb.write_report(rep, path, "json")
    return spark.read.schema(rep.schema).json(path)


@register("f19_no_macro", _with(fx.TRADES_EVENTS_SQL) + """
SELECT count(*) AS "rows", 0 AS with_release, count(DISTINCT id) AS trades FROM trades""")
def _f19(spark, sf):
    """without macro series the macro columns are NULL and every trade keeps its row."""
    f = features.build_features(_trades(spark, sf), None)
    return f.agg(F.count(F.lit(1)).alias("rows"), F.count("days_since_release").alias("with_release"),
                 F.countDistinct("trade_id").alias("trades"))


@register("m16_all_tables", _with(fx.TRADES_EVENTS_SQL) + """
SELECT 'trades' AS "table", 10 AS columns, count(*) AS "rows", '' AS orphaned_columns, count(*) = 0 AS empty FROM trades
UNION ALL SELECT 'feature_store', 51, count(*), '', count(*) = 0 FROM trades
UNION ALL SELECT 'experiments', 11, 0, '', true""")
def _m16_all(spark, sf):
    """M16 over stored tables, the empty ones included."""
    root = scratch_folder(spark, "audit")
    tb.initialize_schema(spark, root)
    t = _trades(spark, sf)
    tb.write_table(t, root, "trades", "overwrite")
    tb.write_table(features.build_features(t, _macro(spark, sf)), root, "feature_store", "overwrite")
    names = ("trades", "feature_store", "experiments")
    return dg.audit_tables({n: tb.read_table(spark, root, n) for n in names})

