"""Evaluation (L1-L27): every report is a DataFrame built from aggregates,
joins and ordered operators; nothing row-level is collected.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantspark.config import Params
from quantspark.functions.stats import corrected_kurt, corrected_skew, safe_div
from quantspark.operators.ordered import exact_median, halo_window, running_sum_max

INF = float("inf")


# ---------------------------------------------------------------------------
# L1 regression metrics
# ---------------------------------------------------------------------------

def regression_metrics(df: DataFrame, y: str = "actual_pnl", yhat: str = "predicted_pnl",
                       by: Sequence[str] = (), r2_single: float | None = None) -> DataFrame:
    """MAE, RMSE, R2 (= 1 - SSE/SST; constant target: 1.0 if perfect else 0.0).

    ``r2_single`` replaces R2 when a group has one row (the fold table uses 0.0).
    """
    e = F.col(yhat) - F.col(y)
    # One pass, partially aggregated: SST = n * var_pop(y) from centred moments, so no row is dealt by ``by``.
    both = e.isNotNull()
    agg = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"),
                              F.sqrt(F.avg(e * e)).alias("rmse"), F.sum(e * e).alias("_sse"),
                              (F.var_pop(F.when(both, F.col(y))) * F.count(e)).alias("_sst"))
    r2 = (F.when(F.col("_sst") > 0, 1.0 - F.col("_sse") / F.col("_sst"))
           .otherwise(F.when(F.col("_sse") == 0, 1.0).otherwise(0.0)))
    if r2_single is not None:
        r2 = F.when(F.col("n") <= 1, F.lit(float(r2_single))).otherwise(r2)
    return agg.withColumn("r2", r2).drop("_sse", "_sst")


# ---------------------------------------------------------------------------
# L2 trading metrics
# ---------------------------------------------------------------------------

TRADING_COLUMNS = ["sharpe_ratio", "sortino_ratio", "max_drawdown", "profit_factor", "average_trade",
                   "win_rate", "calmar_ratio", "expectancy", "recovery_factor", "omega_ratio",
                   "ulcer_index"]


def drawdown_rows(df: DataFrame, value: str, order: Sequence, num_blocks: int | None = None) -> DataFrame:
    """Per row: cumulative sum, running max, drawdown, percent drawdown (block prefix)."""
    x = running_sum_max(df, F.col(value), order, "cum", "runmax", num_blocks)
    dd = F.col("cum") - F.col("runmax")
    return x.withColumn("drawdown", dd).withColumn(
        "pct_drawdown", F.when(F.col("runmax") != 0, dd / F.col("runmax")).otherwise(F.lit(0.0)))


def trading_metrics(df: DataFrame, value: str, order: Sequence, params: Params = Params(),
                    num_blocks: int | None = None) -> DataFrame:
    """L2a-L2h over a return series ordered by ``order``: one row (plus ``n``)."""
    return metrics_from_curve(drawdown_rows(df, value, order, num_blocks), value, "cum", "runmax", params)


def metrics_from_curve(x: DataFrame, value: str, cum: str, runmax: str, params: Params = Params()) -> DataFrame:
    """L2 from per-row returns with their cumulative sum and its running maximum."""
    x = x.withColumn("drawdown", F.col(cum) - F.col(runmax)).withColumn(
        "pct_drawdown", F.when(F.col(runmax) != 0, (F.col(cum) - F.col(runmax)) / F.col(runmax)).otherwise(0.0))
    r = F.col(value)
    a = x.agg(
        F.count(F.lit(1)).alias("n"), F.avg(r).alias("_mean"), F.stddev_samp(r).alias("_std"),
        F.stddev_samp(F.when(r < 0, r)).alias("_dstd"), F.min("drawdown").alias("max_drawdown"),
        F.sum(F.when(r > 0, r)).alias("_gp"), F.sum(F.when(r < 0, r)).alias("_gl"),
        F.count_if(r > 0).alias("_nw"), F.avg(F.when(r > 0, r)).alias("_aw"),
        F.avg(F.when(r < 0, r)).alias("_al"), F.sum(r).alias("_tot"),
        F.max(cum).alias("_final_runmax"), F.avg(F.col("pct_drawdown") ** 2).alias("_msq"))
    ann, rf = float(params.annualization), float(params.risk_free_rate)
    sq = math.sqrt(ann)
    mdd = F.abs(F.col("max_drawdown"))
    wr = safe_div(F.col("_nw"), F.col("n"))
    gl = F.abs(F.coalesce(F.col("_gl"), F.lit(0.0)))
    gp = F.coalesce(F.col("_gp"), F.lit(0.0))
    pf = F.when(gl > 0, gp / gl).otherwise(F.lit(INF))
    return a.select(
        "n",
        F.when(F.col("_std") > 0, (F.col("_mean") - rf) / F.col("_std") * sq).otherwise(0.0).alias("sharpe_ratio"),
        F.when(F.col("_dstd") > 0, (F.col("_mean") - rf) / F.col("_dstd") * sq).otherwise(0.0).alias("sortino_ratio"),
        "max_drawdown",
        pf.alias("profit_factor"),
        F.col("_mean").alias("average_trade"),
        wr.alias("win_rate"),
        F.when(mdd > 0, F.col("_mean") * ann / mdd).otherwise(0.0).alias("calmar_ratio"),
        (wr * F.coalesce(F.col("_aw"), F.lit(0.0))
         - (1 - wr) * F.abs(F.coalesce(F.col("_al"), F.lit(0.0)))).alias("expectancy"),
        F.when(mdd > 0, F.col("_tot") / mdd).otherwise(0.0).alias("recovery_factor"),
        pf.alias("omega_ratio"),
        F.when(F.col("_final_runmax") > 0, F.sqrt(F.col("_msq"))).otherwise(0.0).alias("ulcer_index"),
    )


def trading_metrics_dict(df: DataFrame, value: str, order: Sequence, params: Params = Params()) -> dict:
    """L2i: the metrics as a dict; fewer than 2 rows raises ValueError."""
    row = trading_metrics(df, value, order, params).first()
    if row is None or row["n"] < 2:
        raise ValueError("trading metrics need at least two returns")
    return row.asDict()


# ---------------------------------------------------------------------------
# L3, L4 integrity
# ---------------------------------------------------------------------------

def integrity_report(trades: DataFrame, predictions: DataFrame, others: dict[str, DataFrame] | None = None,
                     experiment_id: str | None = None) -> DataFrame:
    """L3: row counts, join count on trade_id, null counts, orphan predictions (one row)."""
    p = predictions if experiment_id is None else predictions.filter(F.col("experiment_id") == experiment_id)
    t_ids = trades.select(F.col("id").alias("trade_id"))
    one = F.lit(1)
    parts = [trades.agg(F.count(one).alias("rows_trades")),
             p.agg(F.count(one).alias("rows_predictions"),
                   F.count_if(F.col("trade_id").isNull()).alias("null_trade_id"),
                   F.count_if(F.col("actual_pnl").isNull()).alias("null_actual_pnl"),
                   F.count_if(F.col("predicted_pnl").isNull()).alias("null_predicted_pnl")),
             # one left join gives both the joined rows and the orphans
             p.join(t_ids.withColumn("_hit", F.lit(True)), "trade_id", "left").agg(
                 F.count_if(F.col("_hit").isNotNull()).alias("joined_rows"),
                 F.count_if(F.col("_hit").isNull()).alias("orphan_predictions"))]
    for name, df in (others or {}).items():
        parts.append(df.agg(F.count(one).alias(f"rows_{name}")))
    out = parts[0].withColumn("_k", one)
    for q in parts[1:]:
        out = out.join(q.withColumn("_k", one), "_k")  # one-row frames
    out = out.drop("_k")
    empty = F.lit(False)
    for c in out.columns:
        if c.startswith("rows_"):
            empty = empty | (F.col(c) == 0)
    ok = (~empty & (F.col("joined_rows") > 0) & (F.col("null_trade_id") == 0) & (F.col("orphan_predictions") == 0)
          & (F.col("null_actual_pnl") == 0) & (F.col("null_predicted_pnl") == 0))
    return out.withColumn("passed", ok)


def prediction_checks(predictions: DataFrame) -> DataFrame:
    """L4: non-empty, no nulls, (fold, trade_id) unique (one row of violation counts)."""
    dup = (predictions.groupBy("walk_forward_fold", "trade_id").count().filter(F.col("count") > 1)
           .agg(F.count(F.lit(1)).alias("duplicate_keys")))
    base = predictions.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("predicted_pnl").isNull()).alias("null_predicted"),
        F.count_if(F.col("actual_pnl").isNull()).alias("null_actual"),
        F.count_if(F.col("permutation_id").isNull()).alias("null_permutation"))
    out = base.withColumn("_k", F.lit(1)).join(dup.withColumn("_k", F.lit(1)), "_k").drop("_k")
    return out.withColumn("passed", (F.col("rows") > 0) & (F.col("null_predicted") == 0)
                          & (F.col("null_actual") == 0) & (F.col("null_permutation") == 0)
                          & (F.col("duplicate_keys") == 0))


def raise_if_failed(report: DataFrame, what: str) -> None:
    row = report.first()
    if row is None or not row["passed"]:
        raise ValueError(f"{what} failed: {row.asDict() if row else 'empty'}")


# ---------------------------------------------------------------------------
# L5 baselines
# ---------------------------------------------------------------------------

def hashed_normal(key: Column, seed: int) -> Column:
    """A standard normal draw that depends on ``key`` and ``seed`` alone: Box-Muller on two 48-bit md5 uniforms."""
    def uniform(part: str) -> Column:
        digest = F.md5(F.concat(F.lit(f"{seed}-{part}-"), key.cast("string")).cast("binary"))
        return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    return F.sqrt(-2.0 * F.log(uniform("r"))) * F.cos(2.0 * math.pi * uniform("a"))


def baseline_predictions(predictions: DataFrame, order=("timestamp", "trade_id"), seed: int = 42,
                         include_random: bool = False, block_rows: int = 1 << 16) -> DataFrame:
    """Per row the baseline predictions of actual_pnl (ordered by time).

    mean / median use the whole series (a look-ahead kept on purpose: they
    are benchmarks); previous trade and rolling mean of the 10 previous
    rows are causal, and the first row predicts itself.  The noise baseline
    draws from the last order column, so it does not depend on the partitioning.
    """
    y = "actual_pnl"
    stats = (predictions.agg(F.avg(y).alias("_m"), F.stddev_pop(y).alias("_sd"))
             .join(exact_median(predictions, y).withColumnRenamed("median", "_med"), how="inner", on=F.lit(True)))
    x = halo_window(predictions.select(*order, y), 10,
                    lambda w: {"previous_trade": F.lag(y, 1).over(w),
                               "rolling_mean": F.avg(y).over(w.rowsBetween(-10, -1))},
                    order=list(order), block_rows=block_rows)
    x = x.withColumns({"previous_trade": F.coalesce("previous_trade", y),
                       "rolling_mean": F.coalesce("rolling_mean", y)})
    x = x.join(F.broadcast(stats), how="inner", on=F.lit(True))  # one-row frame
    x = x.withColumns({"predict_mean": F.col("_m"), "predict_median": F.col("_med")})
    if include_random:
        x = x.withColumn("random", F.col("_m") + F.col("_sd") * hashed_normal(F.col(order[-1]), seed))
    return x.drop("_m", "_med", "_sd")


def baseline_report(predictions: DataFrame, include_random: bool = False, block_rows: int = 1 << 16) -> DataFrame:
    """MAE / RMSE / R2 of each baseline; one row per baseline."""
    names = ["predict_mean", "predict_median", "previous_trade", "rolling_mean"] + (
        ["random"] if include_random else [])
    x = baseline_predictions(predictions, include_random=include_random, block_rows=block_rows)
    # One wide aggregate: every baseline's errors in one pass over the rows, one output row each.
    y = F.col("actual_pnl")
    stats = []
    for n in names:
        e = F.col(n) - y
        stats += [F.avg(F.abs(e)).alias(f"{n}_mae"), F.avg(e * e).alias(f"{n}_mse"), F.sum(e * e).alias(f"{n}_sse"),
                  F.sum(F.when(e.isNotNull(), (y - F.col("predict_mean")) ** 2)).alias(f"{n}_sst")]
    rows = F.explode(F.array(*[F.struct(
        F.lit(n).alias("baseline"), F.col(f"{n}_mae").alias("mae"), F.sqrt(f"{n}_mse").alias("rmse"),
        F.when(F.col(f"{n}_sst") > 0, 1.0 - F.col(f"{n}_sse") / F.col(f"{n}_sst"))
        .otherwise(F.when(F.col(f"{n}_sse") == 0, 1.0).otherwise(0.0)).alias("r2")) for n in names]))
    return x.agg(*stats).select(rows.alias("_b")).select("_b.*")


# ---------------------------------------------------------------------------
# L6, L7 target audit; L24 Jarque-Bera; L20 histogram
# ---------------------------------------------------------------------------

def lag_pairs(df: DataFrame, value: str, order: Sequence, lag: int = 1, block_rows: int = 1 << 16) -> DataFrame:
    return halo_window(df.select(*order, value), lag,
                       lambda w: {"_prev": F.lag(value, lag).over(w)}, order=list(order), block_rows=block_rows)


def pearson(x: Column, y: Column) -> Column:
    """Pairwise-complete Pearson correlation from centred moments; NULL where a side does not vary."""
    xx, yy = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.stddev_samp(xx) * F.stddev_samp(yy)
    return F.when(spread > 0, F.covar_samp(xx, yy) / spread)


def target_audit(trades: DataFrame, value: str = "pnl", order=("timestamp", "id"),
                 block_rows: int = 1 << 16) -> DataFrame:
    """L6 + L7: one row of target statistics and recommendation flags."""
    lp = lag_pairs(trades, value, order, 1, block_rows)
    ac = lp.agg(pearson(F.col(value), F.col("_prev")).alias("autocorrelation_lag1"))
    m = trades.agg(F.count(value).alias("_n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
                   F.var_samp(value).alias("variance"), F.skewness(value).alias("_g1"),
                   F.kurtosis(value).alias("_g2"), (F.var_pop(value) * F.count(value)).alias("_sst"))
    out = m.join(ac, how="inner", on=F.lit(True))  # one-row frames
    snr = F.when(F.col("std") > 0, F.abs(F.col("mean")) / F.col("std")).otherwise(0.0)
    out = out.select(
        "mean", "std", "variance",
        corrected_skew(F.col("_g1"), F.col("_n")).alias("skewness"),
        corrected_kurt(F.col("_g2"), F.col("_n")).alias("kurtosis"),
        "autocorrelation_lag1", snr.alias("signal_to_noise_ratio"),
        F.when(F.col("_sst") > 0, F.lit(0.0)).otherwise(F.lit(1.0)).alias("baseline_r2"))
    return out.withColumns({
        "advise_low_snr": F.col("signal_to_noise_ratio") < 0.05,
        "advise_skewed": F.abs(F.col("skewness")) > 2.0,
        "advise_autocorrelated": F.col("autocorrelation_lag1") > 0.1,
    })


def jarque_bera(df: DataFrame, value: str) -> DataFrame:
    """JB = n/6 (S^2 + K^2/4) with population moments; p = exp(-JB/2)."""
    a = df.agg(F.count(value).alias("n"), F.skewness(value).alias("_s"), F.kurtosis(value).alias("_k"))
    jb = F.col("n") / 6.0 * (F.col("_s") ** 2 + F.col("_k") ** 2 / 4.0)
    return a.select("n", jb.alias("jb_statistic"), F.exp(-jb / 2.0).alias("jb_p_value"))


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max] (last bin closed): bin, lower, upper, count."""
    b = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    x = df.select(value).filter(F.col(value).isNotNull()).join(F.broadcast(b), how="inner", on=F.lit(True))
    width = (F.col("_hi") - F.col("_lo")) / bins
    idx = F.when(F.col("_hi") > F.col("_lo"),
                 F.least(F.floor((F.col(value) - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(0)
    return (x.withColumn("bin", idx.cast("int"))
             .groupBy("bin").agg(F.count(F.lit(1)).alias("count"), F.first("_lo").alias("_lo"),
                                 F.first("_hi").alias("_hi"))
             .select("bin", (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins).alias("lower"),
                     (F.col("_lo") + (F.col("bin") + 1) * (F.col("_hi") - F.col("_lo")) / bins).alias("upper"),
                     "count"))


# ---------------------------------------------------------------------------
# L8, L9 macro quality
# ---------------------------------------------------------------------------

def series_correlation(series: DataFrame, threshold: float | None = None) -> DataFrame:
    """Pairwise-complete Pearson correlation between series, aligned on date.

    Values meet on their date; each unordered pair is aggregated once and
    mirrored at the end, so nothing is sized by the number of series on the
    driver.
    """
    x = series.filter(F.col("value").isNotNull()).groupBy("series_id", "date").agg(
        F.first("value").cast("double").alias("value"))
    a = x.select("date", F.col("series_id").alias("series_a"), F.col("value").alias("va"))
    b = x.select("date", F.col("series_id").alias("series_b"), F.col("value").alias("vb"))
    half = (a.join(b, "date").filter("series_a < series_b").groupBy("series_a", "series_b")
            .agg(F.count(F.lit(1)).alias("n"), pearson(F.col("va"), F.col("vb")).alias("corr")))
    if threshold is not None:
        half = half.filter(F.abs(F.col("corr")) > threshold)
    both = F.explode(F.array(F.struct("series_a", "series_b"), F.struct(F.col("series_b").alias("series_a"),
                                                                        F.col("series_a").alias("series_b"))))
    return half.select(both.alias("p"), "n", "corr").select("p.series_a", "p.series_b", "n", "corr")


def macro_quality(series: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Per series start, end, missing %, variance, highly correlated partners."""
    base = series.groupBy("series_id").agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date"),
        (F.avg(F.when(F.col("value").isNull(), 1.0).otherwise(0.0)) * 100.0).alias("missing_pct"),
        F.var_samp("value").alias("variance"))
    partners = (series_correlation(series, threshold)
                .groupBy(F.col("series_a").alias("series_id"))
                .agg(F.concat_ws(",", F.array_sort(F.collect_list("series_b"))).alias("high_correlations")))
    return base.join(partners, "series_id", "left").fillna("", ["high_correlations"])


# ---------------------------------------------------------------------------
# L10 drift
# ---------------------------------------------------------------------------

DRIFT_EXCLUDE = {"trade_id", "permutation_id", "pnl"}


def numeric_feature_columns(df: DataFrame, exclude=DRIFT_EXCLUDE) -> list[str]:
    from pyspark.sql import types as T
    num = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.ShortType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, num) and f.name not in exclude]


def feature_drift(features: DataFrame, trades: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Split at the median trade time; |m1 - m2| / (s1 + 1e-9) per feature (0 if s1 = 0)."""
    cols = columns or numeric_feature_columns(features)
    j = features.join(trades.select(F.col("id").alias("trade_id"), F.col("timestamp").alias("trade_timestamp")),
                      "trade_id")
    us = F.unix_micros("trade_timestamp")
    mid = exact_median(j, us).withColumnRenamed("median", "_mid")
    x = j.join(F.broadcast(mid), how="inner", on=F.lit(True))  # one-row frame
    first = us < F.col("_mid")
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        aggs += [F.avg(F.when(first, v)).alias(f"m1_{i}"), F.stddev_samp(F.when(first, v)).alias(f"s1_{i}"),
                 F.avg(F.when(~first, v)).alias(f"m2_{i}"), F.stddev_samp(F.when(~first, v)).alias(f"s2_{i}")]
    wide = x.agg(*aggs)
    long = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"m1_{i}").alias("first_half_mean"),
                 F.col(f"s1_{i}").alias("first_half_std"), F.col(f"m2_{i}").alias("second_half_mean"),
                 F.col(f"s2_{i}").alias("second_half_std")) for i, c in enumerate(cols)])).alias("_d")).select("_d.*")
    s1 = F.col("first_half_std")
    return long.withColumn("drift_score", F.when(s1 > 0, F.abs(F.col("first_half_mean") - F.col("second_half_mean"))
                                                 / (s1 + 1e-9)).otherwise(0.0))


# ---------------------------------------------------------------------------
# L11 stability, L26 model comparison, L27 findings
# ---------------------------------------------------------------------------

def model_stability(fold_results: DataFrame) -> DataFrame:
    """Per winning model: folds won, mean/std MAE, CV, 95% CI, share of folds won."""
    total = fold_results.agg(F.countDistinct("fold").alias("_total"))
    g = fold_results.groupBy(F.col("best_model").alias("model")).agg(
        F.count(F.lit(1)).alias("folds_won"), F.avg("mae").alias("mean_mae"), F.stddev_samp("mae").alias("std_mae"))
    se = F.col("std_mae") / F.sqrt(F.col("folds_won"))
    multi = F.col("folds_won") > 1
    return (g.join(F.broadcast(total), how="inner", on=F.lit(True))
             .select("model", "folds_won", "mean_mae", "std_mae",
                     F.when(F.col("mean_mae") > 0, F.col("std_mae") / F.col("mean_mae")).otherwise(0.0).alias("cv_mae"),
                     F.when(multi, F.col("mean_mae") - 1.96 * se).otherwise(F.col("mean_mae")).alias("ci_95_lower"),
                     F.when(multi, F.col("mean_mae") + 1.96 * se).otherwise(F.col("mean_mae")).alias("ci_95_upper"),
                     (F.col("folds_won") / F.col("_total")).alias("win_share")))


def model_comparison(fold_results: DataFrame) -> DataFrame:
    """L26 + L27: mean metrics per winning model, best flag (lowest mean MAE), findings."""
    g = fold_results.groupBy("best_model").agg(F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"),
                                               F.avg("r2").alias("r2"), F.count(F.lit(1)).alias("folds"))
    best = g.agg(F.min_by("best_model", F.struct("mae", "best_model")).alias("_best"))
    out = g.join(F.broadcast(best), how="inner", on=F.lit(True))  # one-row frame
    return out.select(
        "best_model", "mae", "rmse", "r2", "folds", (F.col("best_model") == F.col("_best")).alias("is_best"),
        F.when(F.col("r2") < 0, "negative_r2").when(F.col("r2") < 0.1, "low_r2").otherwise("meaningful_r2")
        .alias("r2_finding"))


def trading_findings(comparison: DataFrame) -> DataFrame:
    """Findings on the portfolio comparison (one row per portfolio, ``model`` and ``baseline``): whether
    the model's Sharpe ratio is above the baseline's and whether its profits exceed its losses."""
    def of(which, c):
        return F.max(F.when(F.col("portfolio") == which, F.col(c)))
    a = comparison.agg(of("model", "sharpe_ratio").alias("model_sharpe"),
                       of("baseline", "sharpe_ratio").alias("baseline_sharpe"),
                       of("model", "profit_factor").alias("model_profit_factor"))
    return a.select("*", (F.col("model_sharpe") > F.col("baseline_sharpe")).alias("adds_value"),
                    (F.col("model_profit_factor") > 1.0).alias("profitable"))


def fold_summary(fold_results: DataFrame) -> DataFrame:
    """L26 aggregates row: averages over folds and mean sizes."""
    return fold_results.agg(F.count(F.lit(1)).alias("folds"), F.avg("mae").alias("avg_mae"),
                            F.avg("rmse").alias("avg_rmse"), F.avg("r2").alias("avg_r2"),
                            F.avg("train_size").alias("avg_train_size"), F.avg("test_size").alias("avg_test_size"))


# ---------------------------------------------------------------------------
# L12 heat map, L13-L16 equity curves
# ---------------------------------------------------------------------------

def _best_by_slot(g: DataFrame) -> DataFrame:
    w = Window.partitionBy("day_of_week", "hour_of_day").orderBy(
        F.col("predicted_pnl").desc_nulls_last(), F.col("permutation_id"))
    return g.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")


def slot_heatmap(predictions: DataFrame) -> DataFrame:
    """Best permutation per (day_of_week, hour_of_day) by mean predicted pnl (NaN counts as missing).

    Ties go to the smallest permutation id; codes P1..Pn number the sorted
    distinct winners.  The per-slot window runs on the grouped table (at most
    7 x 24 x permutations rows).
    """
    p = predictions.withColumns({"day_of_week": F.weekday("timestamp"), "hour_of_day": F.hour("timestamp")})
    value = F.when(~F.isnan("predicted_pnl"), F.col("predicted_pnl"))
    g = p.groupBy("day_of_week", "hour_of_day", "permutation_id").agg(F.avg(value).alias("predicted_pnl"))
    best = _best_by_slot(g)
    codes = (best.select("permutation_id").distinct()
                 .withColumn("code", F.concat(F.lit("P"), F.dense_rank().over(Window.orderBy("permutation_id"))
                                              .cast("string"))))
    return best.join(F.broadcast(codes), "permutation_id").select(
        "day_of_week", "hour_of_day", "permutation_id", "predicted_pnl", "code")


def slot_pivots(heat: DataFrame) -> DataFrame:
    """The two weekday x hour matrices of a heat map as one frame: per weekday the best permutation
    (``p00``..``p23``) and its mean prediction (``v00``..``v23``) of each hour; empty slots are NULL."""
    hours = range(24)
    return heat.groupBy("day_of_week").agg(
        *[F.max(F.when(F.col("hour_of_day") == h, F.col("permutation_id"))).alias(f"p{h:02d}") for h in hours],
        *[F.max(F.when(F.col("hour_of_day") == h, F.col("predicted_pnl"))).alias(f"v{h:02d}") for h in hours])


def best_prediction_per_timestamp(predictions: DataFrame) -> DataFrame:
    """Per timestamp the prediction with the highest predicted_pnl (first = smallest trade_id);
    NULL and NaN predictions do not compete."""
    valid = F.col("predicted_pnl").isNotNull() & ~F.isnan("predicted_pnl")
    return predictions.filter(valid).groupBy("timestamp").agg(
        F.max_by(F.struct("trade_id", "predicted_pnl"),
                 F.struct(F.col("predicted_pnl"), -F.col("trade_id"))).alias("_b")).select(
        "_b.trade_id", "timestamp", "_b.predicted_pnl")


def model_portfolio(predictions: DataFrame, trades: DataFrame) -> DataFrame:
    """L13 + L14 inputs: best trade per timestamp joined to its realised pnl."""
    best = best_prediction_per_timestamp(predictions)
    t = trades.select(F.col("id").alias("trade_id"), F.col("pnl").alias("realized_pnl"), "permutation_id")
    return best.join(t, "trade_id")


def _curve(predictions: DataFrame, trades: DataFrame, baseline_permutation: str,
           num_blocks: int | None = None) -> DataFrame:
    mp = model_portfolio(predictions, trades)
    base = (trades.filter(F.col("permutation_id") == baseline_permutation)
                  .groupBy("timestamp").agg(F.sum("pnl").alias("baseline_pnl")))
    x = mp.join(base, "timestamp", "left").withColumn("baseline_pnl", F.coalesce("baseline_pnl", F.lit(0.0)))
    x = running_sum_max(x, F.col("realized_pnl"), ["timestamp"], "cumulative_pnl", "model_runmax", num_blocks,
                        keep_blocks=True)
    return running_sum_max(x, F.col("baseline_pnl"), None, "baseline_cumulative_pnl", "baseline_runmax")


def equity_curve(predictions: DataFrame, trades: DataFrame, baseline_permutation: str,
                 num_blocks: int | None = None) -> DataFrame:
    """L14 + L15: per model timestamp, realised pnl and its cumulative sum, and the
    baseline permutation's pnl at the same timestamps (0 when absent) and its sum."""
    return _curve(predictions, trades, baseline_permutation, num_blocks).select(
        "timestamp", "trade_id", "predicted_pnl", "realized_pnl", "cumulative_pnl", "baseline_pnl",
        "baseline_cumulative_pnl")


def portfolio_comparison(predictions: DataFrame, trades: DataFrame, baseline_permutation: str,
                         params: Params = Params(), curve: DataFrame | None = None) -> DataFrame:
    """Trading metrics of the model portfolio and of the baseline, one row each.

    Both come from one equity curve (one ordered pass for the two prefix sums)."""
    c = curve if curve is not None else _curve(predictions, trades, baseline_permutation)
    m = metrics_from_curve(c, "realized_pnl", "cumulative_pnl", "model_runmax", params)
    b = metrics_from_curve(c, "baseline_pnl", "baseline_cumulative_pnl", "baseline_runmax", params)
    return (m.withColumn("portfolio", F.lit("model")).unionByName(b.withColumn("portfolio", F.lit("baseline")))
             .select("portfolio", "n", *TRADING_COLUMNS))


def equity_report(predictions: DataFrame, trades: DataFrame, baseline_permutation: str,
                  params: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """L14-L16 together: the curve and the comparison share one ordered pass."""
    c = _curve(predictions, trades, baseline_permutation)
    return (c.select("timestamp", "trade_id", "predicted_pnl", "realized_pnl", "cumulative_pnl", "baseline_pnl",
                     "baseline_cumulative_pnl"),
            portfolio_comparison(predictions, trades, baseline_permutation, params, curve=c))


# ---------------------------------------------------------------------------
# L17-L19 errors, L21-L22 top features, L23-L25 residual tests
# ---------------------------------------------------------------------------

def residuals(predictions: DataFrame, trades: DataFrame) -> DataFrame:
    """residual = predicted - actual (actual from trades by trade_id), abs error."""
    t = trades.select(F.col("id").alias("trade_id"), F.col("pnl").alias("actual_pnl"))
    r = predictions.drop("actual_pnl").join(t, "trade_id")
    return r.withColumn("residual", F.col("predicted_pnl") - F.col("actual_pnl")).withColumn(
        "abs_error", F.abs(F.col("residual")))


def worst_predictions(res: DataFrame, k: int = 10) -> DataFrame:
    """The k largest absolute errors (ties: smaller trade_id first)."""
    return res.orderBy(F.col("abs_error").desc(), F.col("trade_id")).limit(k)


def permutation_performance(res: DataFrame) -> DataFrame:
    """Realised pnl sum and mean absolute error per permutation."""
    return res.groupBy("permutation_id").agg(F.sum("actual_pnl").alias("actual_pnl"),
                                             F.avg("abs_error").alias("abs_error"))


def top_k(df: DataFrame, value: str, k: int = 20, key: str = "feature") -> DataFrame:
    """Top-k rows by ``value`` (ties by key)."""
    return df.orderBy(F.col(value).desc(), F.col(key)).limit(k)


def mean_abs_attribution(attributions: DataFrame, k: int = 20) -> DataFrame:
    """Mean |value| per feature over folds, top k."""
    g = attributions.groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs_value"))
    return top_k(g, "mean_abs_value", k)


def durbin_watson(res: DataFrame, order=("timestamp", "trade_id"), block_rows: int = 1 << 16) -> DataFrame:
    """Sum (e_t - e_{t-1})^2 / sum e^2 with e = actual - predicted in time order."""
    e = res.select(*order, (F.col("actual_pnl") - F.col("predicted_pnl")).alias("e"))
    lp = lag_pairs(e, "e", order, 1, block_rows)
    d = F.col("e") - F.col("_prev")
    return lp.agg(F.sum(d * d).alias("_num"), F.sum(F.col("e") ** 2).alias("_den")).select(
        safe_div(F.col("_num"), F.col("_den")).alias("durbin_watson"))


def white_test(res: DataFrame) -> dict:
    """White's LM = n R^2 of e^2 on {1, p, p^2, p^3, p^4} (p = predicted), chi2 with 4 df.

    One pass of moment sums (p standardised for conditioning); the 5 x 5
    normal equations are solved on the driver.
    """
    import numpy as np
    e2 = (F.col("actual_pnl") - F.col("predicted_pnl")) ** 2
    st = res.agg(F.avg("predicted_pnl").alias("m"), F.stddev_pop("predicted_pnl").alias("s")).first()
    if st["m"] is None:
        return {"statistic": float("nan"), "p_value": float("nan"), "n": 0}
    s = st["s"] or 1.0
    z = (F.col("predicted_pnl") - st["m"]) / s
    aggs = [F.count(F.lit(1)).alias("n")] + [F.sum(z ** k).alias(f"z{k}") for k in range(1, 9)]
    aggs += [F.sum(e2 * z ** k).alias(f"ez{k}") for k in range(0, 5)] + [F.sum(e2 * e2).alias("ee")]
    r = res.agg(*aggs).first()
    n = r["n"]
    zs = [float(n)] + [r[f"z{k}"] for k in range(1, 9)]
    xtx = np.array([[zs[i + j] for j in range(5)] for i in range(5)])
    xty = np.array([r[f"ez{k}"] for k in range(5)])
    beta = np.linalg.lstsq(xtx, xty, rcond=None)[0]
    ybar = xty[0] / n
    sst = r["ee"] - n * ybar * ybar
    ssr = r["ee"] - beta @ xty
    r2 = 1.0 - ssr / sst if sst > 0 else 0.0
    lm = n * r2
    return {"statistic": float(lm), "p_value": float(math.exp(-lm / 2.0) * (1.0 + lm / 2.0)), "n": int(n)}


def residual_tests(res: DataFrame, block_rows: int = 1 << 16) -> DataFrame:
    """L23-L25 in one row (White's statistic is computed from one moment pass)."""
    e = res.withColumn("e", F.col("actual_pnl") - F.col("predicted_pnl"))
    dw = durbin_watson(res, block_rows=block_rows)
    jb = jarque_bera(e, "e")
    w = white_test(res)
    return (dw.join(jb, how="inner", on=F.lit(True))  # one-row frames
              .withColumns({"white_statistic": F.lit(w["statistic"]), "white_p_value": F.lit(w["p_value"])}))
