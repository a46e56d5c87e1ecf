"""Model matrix (H), walk-forward training and selection (J).

Folds are time ranges (``plans.folds``); the driver loops over folds and
model configurations, and every fit / score is a distributed job on a
time-filtered DataFrame: moment sums for linear models, MLlib for the random
forest, ``plans.boosting`` for boosted trees.  Only small values reach the driver:
per-feature means/stds (p numbers), coefficients, validation MAEs.
"""

from __future__ import annotations

import itertools
import json
import math
import random
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantspark.config import Params
from quantspark.plans import boosting
from quantspark.plans.evaluate import regression_metrics
from quantspark.operators.ordered import POS, with_position
from quantspark.plans.folds import cv_block_column, fold_bounds, fold_table

# Columns that training itself adds.
WORKING_COLUMNS = frozenset({"walk_forward_fold", "cv_split", POS})
CATEGORICAL_COLUMNS = frozenset({"market_session", "event_importance"})
# Fixed codes of the categorical encodings.
SESSION_CODES = {"asia": 0, "europe": 1, "us": 2, "off_hours": 3}
IMPORTANCE_CODES = {"low": 0, "medium": 1, "high": 2}
SCALED_MODELS = ("linear_regression", "ridge", "lasso", "elasticnet", "random_forest")
LINEAR_MODELS = ("linear_regression", "ridge", "lasso", "elasticnet")
# What the boosting presets take for parameters that a configuration leaves out.
BOOSTING_PRESETS = {"xgboost": {"max_depth": 6, "l2": 1.0}, "catboost": {"max_depth": 6, "l2": 3.0},
                    "lightgbm": {"max_depth": 12, "l2": 0.0, "num_leaves": 31, "min_rows": 20}}
BOOSTING_NAMES = {"n_estimators": "trees", "iterations": "trees", "max_depth": "max_depth", "depth": "max_depth",
                  "learning_rate": "learning_rate", "num_leaves": "num_leaves", "l2_leaf_reg": "l2",
                  "subsample": "subsample", "colsample_bytree": "colsample"}

# Hyper-parameter grids (fixed values of the configuration).
DEFAULT_GRIDS = {
    "ridge": {"alpha": [0.1, 1.0, 10.0]},
    "lasso": {"alpha": [0.01, 0.1, 1.0]},
    "elasticnet": {"alpha": [0.01, 0.1, 1.0], "l1_ratio": [0.2, 0.5, 0.8]},
    "random_forest": {"n_estimators": [50, 100, 200], "max_depth": [5, 10, 20], "min_samples_split": [2, 5]},
    "xgboost": {"n_estimators": [50, 100, 200], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.05, 0.1],
                "subsample": [0.7, 0.8], "colsample_bytree": [0.7, 0.8]},
    "lightgbm": {"n_estimators": [50, 100, 200], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.05, 0.1],
                 "subsample": [0.7, 0.8], "colsample_bytree": [0.7, 0.8], "num_leaves": [15, 31, 63]},
    "catboost": {"iterations": [50, 100, 200], "depth": [4, 6, 8], "learning_rate": [0.01, 0.05, 0.1],
                 "l2_leaf_reg": [1, 3, 5]},
}
DEFAULT_MODELS = ("linear_regression", "ridge", "lasso", "elasticnet", "random_forest", "xgboost",
                  "lightgbm", "catboost")


# ---------------------------------------------------------------------------
# H: model matrix
# ---------------------------------------------------------------------------

def prepare(features: DataFrame, trades: DataFrame | None = None) -> DataFrame:
    """H1-H4: add trade_timestamp (inner join on trade_id), encode categoricals, numeric nulls -> 0."""
    df = features
    if trades is not None and "trade_timestamp" not in df.columns:
        df = df.join(trades.select(F.col("id").alias("trade_id"), F.col("timestamp").alias("trade_timestamp")),
                     "trade_id")
    if "market_session" in df.columns:
        m = F.create_map(*[F.lit(x) for kv in SESSION_CODES.items() for x in kv])
        df = df.withColumn("market_session_encoded", F.coalesce(m[F.col("market_session")], F.lit(3)).cast("int"))
    if "event_importance" in df.columns:
        m = F.create_map(*[F.lit(x) for kv in IMPORTANCE_CODES.items() for x in kv])
        df = df.withColumn("event_importance_encoded",
                           F.coalesce(m[F.lower(F.col("event_importance"))], F.lit(0)).cast("int"))
    num = [f.name for f in df.schema.fields
           if isinstance(f.dataType, (T.IntegerType, T.LongType, T.DoubleType, T.FloatType))]
    return df.fillna(0, subset=num)


def feature_columns(df: DataFrame, label: str = "pnl") -> list[str]:
    """H5: numeric columns that are neither a key (``*_id``), the label, a raw category nor a working column, sorted
    (encoded categoricals included)."""
    num = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType)
    return sorted(f.name for f in df.schema.fields if isinstance(f.dataType, num) and not f.name.endswith("_id")
                  and f.name != label and f.name not in CATEGORICAL_COLUMNS | WORKING_COLUMNS)


# ---------------------------------------------------------------------------
# estimators
# ---------------------------------------------------------------------------

@dataclass
class FittedModel:
    name: str
    config: dict
    feature_cols: list
    means: list | None
    stds: list | None
    model: object
    label: str = "pnl"
    extra: dict = field(default_factory=dict)

    def _assemble(self, df: DataFrame) -> DataFrame:
        if self.means is not None:
            df = df.withColumns({f"_z{i}": (F.col(c).cast("double") - m) / s
                                 for i, (c, m, s) in enumerate(zip(self.feature_cols, self.means, self.stds))})
            cols = [f"_z{i}" for i in range(len(self.feature_cols))]
        else:
            cols = self.feature_cols
        out = VectorAssembler(inputCols=cols, outputCol="_features", handleInvalid="keep").transform(df)
        return out.drop(*[c for c in cols if c.startswith("_z")])

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        pred = self.model.transform(self._assemble(df))
        if out != "prediction":
            pred = pred.withColumnRenamed("prediction", out)
        return pred.drop("_features")

    def coefficients(self) -> dict | None:
        if hasattr(self.model, "coefficients"):
            return dict(zip(self.feature_cols, [float(x) for x in self.model.coefficients.toArray()]))
        return None

    def raw_coefficients(self) -> dict | None:
        """Coefficients in the units of the unscaled features."""
        coef = self.coefficients()
        if coef is None or self.means is None:
            return coef
        return {c: v / s for (c, v), s in zip(coef.items(), self.stds)}

    def native_importance(self) -> dict:
        """Tree importances, or |coef| normalised to sum 1."""
        if hasattr(self.model, "featureImportances"):
            v = [float(x) for x in self.model.featureImportances.toArray()]
        else:
            v = [abs(float(x)) for x in self.model.coefficients.toArray()]
        s = sum(v)
        return {c: (x / s if s > 0 else 0.0) for c, x in zip(self.feature_cols, v)}


def _scaling(df: DataFrame, cols: list[str]) -> tuple[list, list]:
    """Per-feature mean and population std (std 0 -> 1); 2p numbers to the driver."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m{i}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}")]
    r = df.agg(*aggs).first()
    means = [r[f"m{i}"] or 0.0 for i in range(len(cols))]
    stds = [(r[f"s{i}"] if r[f"s{i}"] else 1.0) for i in range(len(cols))]
    return means, stds


def _tree_depth(depth) -> int:
    """MLlib grows trees up to depth 30; a deeper request is an error, not a shallower tree."""
    if int(depth) > 30:
        raise ValueError(f"tree depth {depth} is above MLlib's limit of 30")
    return int(depth)


def make_estimator(name: str, cfg: dict, n: int, s_y: float, seed: int, label: str):
    """The random forest as an MLlib estimator (linear models: :func:`fit_linear`, boosting:
    :func:`fit_boosting`)."""
    if name == "random_forest":
        return RandomForestRegressor(numTrees=int(cfg.get("n_estimators", 100)),
                                     maxDepth=_tree_depth(cfg.get("max_depth", 10)),
                                     minInstancesPerNode=max(1, int(cfg.get("min_samples_split", 2)) // 2),
                                     seed=seed, featuresCol="_features", labelCol=label)
    raise ValueError(f"unknown model {name}")


def fit(name: str, cfg: dict, df: DataFrame, feature_cols: list[str], label: str = "pnl",
        seed: int = 42, ready: boosting.Binned | None = None) -> FittedModel:
    """Any model on the rows of ``df`` (``ready``: the same rows binned, which boosting then takes)."""
    if name in LINEAR_MODELS:
        return fit_linear(name, cfg, df, feature_cols, label)
    if name in BOOSTING_PRESETS:
        return fit_boosting(name, cfg, df, feature_cols, label, seed, ready)
    means = stds = None
    if name in SCALED_MODELS:
        means, stds = _scaling(df, feature_cols)
    st = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(label).alias("sy")).first()
    n, s_y = int(st["n"]), float(st["sy"] or 1.0)
    fm = FittedModel(name, dict(cfg), list(feature_cols), means, stds, None, label)
    est = make_estimator(name, cfg, n, s_y if s_y > 0 else 1.0, seed, label)
    fm.model = est.fit(fm._assemble(df))
    return fm


def grid(name: str, grids: dict, tuner: str = "gridsearch", trials: int = 20, seed: int = 42) -> list[dict]:
    """Configurations to try (linear regression is never tuned)."""
    g = grids.get(name, {})
    if name == "linear_regression" or not g:
        return [{}]
    keys = sorted(g)
    configs = [dict(zip(keys, vals)) for vals in itertools.product(*[g[k] for k in keys])]
    if tuner == "sampled" and name not in LINEAR_MODELS and len(configs) > trials:
        configs = random.Random(seed).sample(configs, trials)
    return configs


def _mae(pred: DataFrame, label: str) -> float:
    return pred.agg(F.avg(F.abs(F.col("prediction") - F.col(label)))).first()[0]


class BoostedFitted(FittedModel):
    """Boosted trees; scoring reads the feature columns in Arrow batches."""

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.model.expr(self.feature_cols))

    def native_importance(self) -> dict:
        return dict(zip(self.feature_cols, [float(v) for v in self.model.importance()]))


def fit_boosting(name: str, cfg: dict, df: DataFrame, feature_cols: list[str], label: str = "pnl",
                 seed: int = 42, ready: boosting.Binned | None = None) -> BoostedFitted:
    """A preset of the boosted trees; a parameter it does not know is an error."""
    own = {"trees": 100, **BOOSTING_PRESETS[name], **{BOOSTING_NAMES[k]: v for k, v in cfg.items()}}
    model = boosting.fit(df, list(feature_cols), label, seed=seed, ready=ready, **own)
    return BoostedFitted(name, dict(cfg), list(feature_cols), None, None, model, label)


class LinearFitted(FittedModel):
    """A linear model solved from moment sums; scoring is one native expression."""

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.model.expr(self.feature_cols))

    def coefficients(self) -> dict:
        return dict(zip(self.feature_cols, [float(x) for x in self.model.beta]))

    def raw_coefficients(self) -> dict:
        return dict(zip(self.feature_cols, [float(x) for x in self.model.w]))

    def native_importance(self) -> dict:
        v = [abs(float(x)) for x in self.model.beta]
        s = sum(v)
        return {c: (x / s if s > 0 else 0.0) for c, x in zip(self.feature_cols, v)}


def _shift(df: DataFrame, cols: list[str], label: str) -> dict:
    """Per-column means used to centre the moment sums (p + 1 numbers)."""
    r = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
               F.avg(F.col(label).cast("double")).alias("my")).first()
    d = {c: (r[f"m{i}"] or 0.0) for i, c in enumerate(cols)}
    d[label] = r["my"] or 0.0
    return d


def fit_linear(name: str, cfg: dict, df: DataFrame, feature_cols: list[str], label: str = "pnl") -> LinearFitted:
    from quantspark.functions.linalg import block_moments, solve
    import numpy as np
    sh = _shift(df, feature_cols, label)
    m = block_moments(df, feature_cols, label, None, sh)[None]
    sol = solve(m, name, cfg, np.array([sh[c] for c in feature_cols]), sh[label])
    return LinearFitted(name, dict(cfg), list(feature_cols), None, None, sol, label)


def optimality(model: LinearFitted, df: DataFrame) -> DataFrame:
    """How far each feature is from the optimality conditions of its model, in units of the label's spread.

    With z the standardised feature, r the residual and n the rows, a minimum of
    the model's objective has mean(z r) equal to 0 (least squares), alpha b / n
    (ridge), or alpha l1 sign(b) + alpha (1 - l1) b (lasso, elastic net; at most
    alpha l1 in size where b is 0).  The residuals come from the model's
    predictions, so nothing of the solver is taken on trust; one aggregation.
    """
    cols, beta = model.feature_cols, model.model.beta
    r = F.col(model.label).cast("double") - F.col("_pred")
    got = model.transform(df, "_pred").agg(
        F.count(F.lit(1)).alias("n"), F.stddev_pop(F.col(model.label).cast("double")).alias("sy"),
        *[(F.sum((F.col(c).cast("double") - F.lit(float(m))) * r) / F.lit(float(s))).alias(f"g{j}")
          for j, (c, m, s) in enumerate(zip(cols, model.model.mean, model.model.std))]).first()
    alpha, n = float(model.config.get("alpha", 1.0)), max(got["n"], 1)
    l1 = 1.0 if model.name == "lasso" else float(model.config.get("l1_ratio", 0.5))
    rows = []
    for j, (c, b) in enumerate(zip(cols, beta)):
        g = (got[f"g{j}"] or 0.0) / n
        if model.name == "linear_regression":
            off = abs(g)
        elif model.name == "ridge":
            off = abs(g - alpha * b / n)
        elif b != 0.0:
            off = abs(g - alpha * l1 * math.copysign(1.0, b) - alpha * (1 - l1) * b)
        else:
            off = max(0.0, abs(g) - alpha * l1)
        rows.append((model.name, c, float(off / (got["sy"] or 1.0))))
    return df.sparkSession.createDataFrame(rows, "model string, feature string, violation double")


def search(models, grids: dict, train: DataFrame, feature_cols: list[str], label: str, params: Params,
           n_splits: int = 3, threads: int = 4, shift: dict | None = None,
           ctx: dict | None = None) -> list[tuple[str, dict, float]]:
    """Per model the configuration with the lowest mean validation MAE over the
    time-ordered splits (first on ties).  ``train`` carries ``cv_block``.

    Linear models: one grouped moment aggregation (per cv block), every split
    and configuration solved on the driver, and all validation MAEs in one
    more aggregation.  The random forest fits on cached assembled splits, boosting on
    the rows of each split, overlapped from a small driver thread pool.
    """
    import numpy as np
    from concurrent.futures import ThreadPoolExecutor
    from quantspark.functions.linalg import Moments, block_moments, solve
    best = {}
    lin = [m for m in models if m in LINEAR_MODELS]
    if lin:
        sh = shift or _shift(train, feature_cols, label)
        blocks = block_moments(train, feature_cols, label, "cv_block", sh)
        sx = np.array([sh[c] for c in feature_cols])
        if ctx is not None:  # the caller refits the winner from the same block moments
            ctx.update(blocks=blocks, shift=sh, sx=sx)
        jobs, sols = [], []
        for name in lin:
            for cfg in grid(name, grids, params.tuner, params.sampled_trials, params.seed):
                for s in range(n_splits):
                    parts = [blocks[b] for b in range(s + 1) if b in blocks]
                    if not parts or (s + 1) not in blocks:
                        continue
                    mom = parts[0]
                    for q in parts[1:]:
                        mom = mom + q
                    jobs.append((name, json.dumps(cfg, sort_keys=True), cfg, s + 1))
                    sols.append(solve(mom, name, cfg, sx, sh[label]))
        if sols:
            from quantspark.functions.linalg import block_abs_errors
            W = np.column_stack([so.w for so in sols])
            b0 = np.array([so.intercept for so in sols])
            errs = block_abs_errors(train, feature_cols, label, "cv_block", W, b0)  # one pass for all
            acc = {}
            for i, (name, key, cfg, vb) in enumerate(jobs):
                n_v, sums = errs.get(vb, (0.0, None))
                mae = sums[i] / n_v if n_v else math.inf
                acc.setdefault((name, key), [cfg, []])[1].append(mae)
            for (name, _), (cfg, maes) in acc.items():
                v = sum(maes) / len(maes)
                if name not in best or v < best[name][1]:
                    best[name] = (cfg, v)
    trees = [m for m in models if m not in LINEAR_MODELS]
    if trees:
        inputs = {}
        for s in range(n_splits):
            fit_rows = train.filter(F.col("cv_block") <= s)
            val_rows = train.filter(F.col("cv_block") == s + 1)
            st = fit_rows.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(label).alias("sy")).first()
            for scaled in {m in SCALED_MODELS for m in trees if m not in BOOSTING_PRESETS}:
                means, stds = _scaling(fit_rows, feature_cols) if scaled else (None, None)
                tmpl = FittedModel("", {}, list(feature_cols), means, stds, None, label)
                inputs[(s, scaled)] = (tmpl._assemble(fit_rows).select("_features", label).cache(),
                                       tmpl._assemble(val_rows).select("_features", label).cache(),
                                       int(st["n"]), float(st["sy"] or 1.0))
        def boosted(name, cfg, s):
            m = fit_boosting(name, cfg, train.filter(F.col("cv_block") <= s), feature_cols, label, params.seed)
            return _mae(m.transform(train.filter(F.col("cv_block") == s + 1)), label)

        jobs = [(name, cfg) for name in trees
                for cfg in grid(name, grids, params.tuner, params.sampled_trials, params.seed)]

        def run(job):
            name, cfg = job
            maes = []
            for s in range(n_splits):
                if name in BOOSTING_PRESETS:
                    maes.append(boosted(name, cfg, s))
                    continue
                fdf, vdf, n, s_y = inputs[(s, name in SCALED_MODELS)]
                m = make_estimator(name, cfg, n, s_y, params.seed, label).fit(fdf)
                maes.append(_mae(m.transform(vdf), label))
            maes = [v for v in maes if v is not None]        # an empty block has none
            return sum(maes) / len(maes) if maes else math.inf

        with ThreadPoolExecutor(max_workers=threads) as pool:
            results = list(pool.map(run, jobs))
        for v in inputs.values():
            v[0].unpersist()
            v[1].unpersist()
        for (name, cfg), mae in zip(jobs, results):
            if name not in best or mae < best[name][1]:
                best[name] = (cfg, mae)
    return [(name, best[name][0], best[name][1]) for name in models if name in best]


def stack_linear(cv: DataFrame, feature_cols: list[str], label: str, base: list[tuple[str, dict]],
                 alpha: float = 1.0, n_splits: int = 3) -> tuple[float, "LinearFitted"]:
    """Ridge (unscaled, ``alpha``) on out-of-fold predictions of linear base models.

    Out-of-fold predictions of validation block b come from base models fitted on
    blocks < b (time-ordered, a stated deviation from unordered K-fold).  The
    stacker's validation MAE trains it on OOF blocks 1..s and scores block s+1.
    Base models and stacker are linear, so the final stack is one linear model
    (refitted bases combined with the stacker weights).
    """
    import numpy as np
    from quantspark.functions.linalg import LinearSolution, block_moments, solve, total
    sh = _shift(cv, feature_cols, label)
    sx = np.array([sh[c] for c in feature_cols])
    blocks = block_moments(cv, feature_cols, label, "cv_block", sh)
    oof = {}
    for name, cfg in base:
        e = None
        for s in range(n_splits):
            mom = total(blocks, range(s + 1))
            if mom is None:
                continue
            sol = solve(mom, name, cfg, sx, sh[label])
            cond = F.col("cv_block") == s + 1
            e = F.when(cond, sol.expr(feature_cols)) if e is None else e.when(cond, sol.expr(feature_cols))
        oof[f"_oof_{name}"] = e
    x = cv.filter(F.col("cv_block") >= 1).withColumns(oof)
    ocols = list(oof)
    ob = block_moments(x, ocols, label, "cv_block", {})
    zero = np.zeros(len(ocols))
    exprs = []
    for s in range(1, n_splits):
        mom = total(ob, range(1, s + 1))
        if mom is None or (s + 1) not in ob:
            continue
        st = solve(mom, "ridge", {"alpha": alpha}, zero, 0.0, standardize=False)
        exprs.append(F.avg(F.when(F.col("cv_block") == s + 1, F.abs(F.col(label) - st.expr(ocols)))))
    maes = [v for v in x.agg(*exprs).first()] if exprs else []
    val_mae = float(sum(maes) / len(maes)) if maes else math.inf
    st = solve(total(ob, range(1, n_splits + 1)), "ridge", {"alpha": alpha}, zero, 0.0, standardize=False)
    full = total(blocks, range(n_splits + 1))
    sols = [solve(full, name, cfg, sx, sh[label]) for name, cfg in base]
    w = sum(a * s_.w for a, s_ in zip(st.w, sols))
    beta = sum(a * s_.beta for a, s_ in zip(st.w, sols))
    b0 = st.intercept + sum(a * s_.intercept for a, s_ in zip(st.w, sols))
    combined = LinearSolution(float(b0), np.asarray(w), np.asarray(beta), sols[0].mean, sols[0].std)
    return val_mae, LinearFitted("stacking", {"base": [n for n, _ in base], "alpha": alpha},
                                 list(feature_cols), None, None, combined, label)


class StackedFitted(FittedModel):
    """``model`` holds (base models, weight of each, intercept)."""

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        bases, weights, intercept = self.model
        names = [f"_base_{i}" for i in range(len(bases))]
        for b, c in zip(bases, names):
            df = b.transform(df, c)
        total = reduce(lambda x, y: x + y, [F.lit(float(w)) * F.col(c) for w, c in zip(weights, names)])
        return df.withColumn(out, total + F.lit(float(intercept))).drop(*names)

    def native_importance(self) -> dict:
        """The bases' importances by the size of their weights, sum 1."""
        bases, weights, _ = self.model
        size = sum(abs(w) for w in weights) or 1.0
        parts = [(abs(w) / size, b.native_importance()) for b, w in zip(bases, weights)]
        return {c: sum(w * imp[c] for w, imp in parts) for c in self.feature_cols}


def stack(cv: DataFrame, feature_cols: list[str], label: str, base: list[tuple[str, dict]], alpha: float = 1.0,
          n_splits: int = 3, seed: int = 42) -> tuple[float, StackedFitted]:
    """J10 over any base models: ridge (unscaled, ``alpha``) on their out-of-fold predictions.

    A row of validation block b gets the predictions of models fitted on the
    blocks before b.  A row is in one block, so the out-of-fold table is the
    union of the blocks, each scored by its own models: no join.  Validation
    and the final refit are those of :func:`stack_linear`.
    """
    import numpy as np
    from quantspark.functions.linalg import block_moments, solve, total
    names = [f"_oof_{i}" for i in range(len(base))]
    parts = []
    for s in range(n_splits):
        seen = cv.filter(F.col("cv_block") <= s)
        rows = cv.filter(F.col("cv_block") == s + 1)
        if not seen.take(1) or not rows.take(1):
            continue
        for (name, cfg), c in zip(base, names):
            rows = fit(name, cfg, seen, feature_cols, label, seed).transform(rows, c)
        parts.append(rows.select("cv_block", F.col(label).cast("double").alias(label), *names))
    bases = [fit(name, cfg, cv, feature_cols, label, seed) for name, cfg in base]
    config = {"base": [name for name, _ in base], "alpha": alpha}
    if not parts:
        even = [1.0 / len(base)] * len(base)
        return math.inf, StackedFitted("stacking", config, list(feature_cols), None, None, (bases, even, 0.0), label)
    oof = reduce(DataFrame.unionByName, parts).persist()
    blocks = block_moments(oof, names, label, "cv_block", {})
    zero = np.zeros(len(names))

    def weights(upto):
        return solve(total(blocks, range(1, upto + 1)), "ridge", {"alpha": alpha}, zero, 0.0, standardize=False)

    exprs = [F.avg(F.when(F.col("cv_block") == s + 1, F.abs(F.col(label) - weights(s).expr(names))))
             for s in range(1, n_splits) if total(blocks, range(1, s + 1)) is not None and s + 1 in blocks]
    maes = list(oof.agg(*exprs).first()) if exprs else []
    last = weights(n_splits)
    oof.unpersist()
    return (float(sum(maes) / len(maes)) if maes else math.inf,
            StackedFitted("stacking", config, list(feature_cols), None, None,
                          (bases, [float(w) for w in last.w], float(last.intercept)), label))


@dataclass
class TrainResult:
    predictions: DataFrame
    fold_results: DataFrame
    importances: DataFrame
    scores: DataFrame
    models: list


COEFFICIENT_BYTES = 64 << 20       # coefficient table broadcast up to this size, joined above it


def score_linear_folds(data: DataFrame, winners: list, fb: dict, feats: list[str]) -> DataFrame:
    """``predicted_pnl`` and ``walk_forward_fold`` of the test rows of all folds that a linear model won,
    in one scan.

    Test windows of neighbouring folds follow one another, so a row's fold is
    arithmetic on its time; ``winners`` (window number, fold, model) become a
    table of coefficient arrays joined on the window number.
    """
    spark = data.sparkSession
    rows = [(int(n), int(k), float(m.model.intercept), [float(x) for x in m.model.w]) for n, k, m in winners]
    table = spark.createDataFrame(rows, "_window bigint, walk_forward_fold int, _b double, _w array<double>")
    if 8 * len(rows) * (len(feats) + 3) <= COEFFICIENT_BYTES:
        table = F.broadcast(table)
    window = F.floor((F.unix_micros("trade_timestamp") - F.lit(fb["t0"] + fb["train"])) / F.lit(fb["test"]))
    score = F.col("_b")
    for j, c in enumerate(feats):
        score = score + F.col("_w")[j] * F.col(c).cast("double")
    return (data.withColumn("_window", window).join(table, "_window")
            .withColumn("predicted_pnl", score).drop("_window", "_b", "_w"))


def train_walk_forward(data: DataFrame, params: Params = Params(), models=("linear_regression", "ridge", "lasso"),
                       grids: dict | None = None, experiment_id: str = "exp", label: str = "pnl",
                       strict: bool = False) -> TrainResult:
    """Per fold, search every model on the fold's train rows, pick the lowest
    validation MAE, predict the test rows; returns predictions, fold table, importances.
    ``strict`` also checks the finished run (M10) and raises on unusable folds."""
    from quantspark.plans.diagnose import check_importances, check_metrics, check_params, raise_if_unusable
    spark = data.sparkSession
    grids = DEFAULT_GRIDS if grids is None else grids
    feats = feature_columns(data)
    raise_if_unusable(data, feats, label)                  # M9
    for name in models:                                    # M10
        for values in grids.get(name, {}).values():
            check_params(dict(enumerate(values)))
    # One position index of the whole matrix (the only range shuffle, however many folds).  A fold's
    # windows are runs of positions, so its rows are a timestamp filter and its validation blocks
    # arithmetic on (position, first position, rows).
    data = with_position(data, ["trade_timestamp", "trade_id"])
    shift = _shift(data, feats, label)  # one centring constant for every fold's moment sums
    fb = fold_bounds(data, "trade_timestamp", params)
    folds = fold_table(data, "trade_timestamp", POS, params, fb)
    ts = F.col("trade_timestamp")
    preds, linear, score_rows, imp_rows, fitted, windows = [], [], [], [], [], []
    for k, f in enumerate(folds):
        s0 = fb["t0"] + f["k"] * fb["test"]
        tr0, tr1, te1 = (F.timestamp_micros(F.lit(x)) for x in (
            fb["t0"] if params.expanding else s0, s0 + fb["train"], s0 + fb["train"] + fb["test"]))
        cv = data.filter((ts >= tr0) & (ts < tr1)).withColumn(
            "cv_block", cv_block_column(POS, f["p0"], f["train_size"])).persist()
        train, test = cv, data.filter((ts >= tr1) & (ts < te1))
        windows.append((k, *(f[c] for c in ("train_size", "train_start", "train_end", "test_size", "test_start",
                                            "test_end"))))
        best_name, best_cfg, best_mae = None, None, math.inf
        ctx = {}
        searched = search(models, grids, cv, feats, label, params, shift=shift, ctx=ctx)
        for order, (name, cfg, mae) in enumerate(searched):
            score_rows.append((k, name, order, float(mae), json.dumps(cfg)))
            if mae < best_mae:  # J11: first model wins ties
                best_name, best_cfg, best_mae = name, cfg, mae
        stacked = None
        base = [(n, c) for n, c, _ in searched]
        if params.enable_stacking and len(base) > 1:
            if all(n in LINEAR_MODELS for n, _ in base):
                s_mae, stacked = stack_linear(cv, feats, label, base)
            else:
                s_mae, stacked = stack(cv, feats, label, base, seed=params.seed)
            score_rows.append((k, "stacking", len(searched), float(s_mae), json.dumps(stacked.config)))
            if s_mae < best_mae:
                best_name, best_cfg, best_mae = "stacking", stacked.config, s_mae
        if best_name == "stacking":
            model = stacked
        elif best_name in LINEAR_MODELS and ctx:
            from quantspark.functions.linalg import solve, total
            sol = solve(total(ctx["blocks"], range(4)), best_name, best_cfg, ctx["sx"], ctx["shift"][label])
            model = LinearFitted(best_name, dict(best_cfg), list(feats), None, None, sol, label)
        else:
            model = fit(best_name, best_cfg, train, feats, label, params.seed)
        fitted.append((k, model))
        if isinstance(model, LinearFitted):
            linear.append((f["k"], k, model))
        else:
            preds.append(model.transform(test, "predicted_pnl").withColumn("walk_forward_fold", F.lit(k).cast("int")))
        for feat, v in model.native_importance().items():
            imp_rows.append((k, best_name, feat, float(v)))
        cv.unpersist()
    schema = "walk_forward_fold int, trade_id long, timestamp timestamp, permutation_id string, " \
             "predicted_pnl double, actual_pnl double, experiment_id string"
    if linear:
        preds.insert(0, score_linear_folds(data, linear, fb, feats))
    if preds:
        predictions = reduce(DataFrame.unionByName, [p.select(
            "trade_id", F.col("trade_timestamp").alias("timestamp"), "permutation_id", "predicted_pnl",
            F.col(label).alias("actual_pnl"), "walk_forward_fold", F.lit(experiment_id).alias("experiment_id"))
            for p in preds])
    else:
        predictions = spark.createDataFrame([], schema)
    scores = spark.createDataFrame(score_rows, "walk_forward_fold int, model string, model_order int, "
                                               "validation_mae double, config string")
    best = scores.groupBy("walk_forward_fold").agg(F.min_by("model", F.struct("validation_mae", "model_order"))
                                                   .alias("best_model"))
    from quantspark.plans.selection import fold_metrics
    win = spark.createDataFrame(windows, "walk_forward_fold int, train_size long, train_start timestamp, "
                                         "train_end timestamp, test_size long, test_start timestamp, test_end timestamp")
    fold_results = fold_metrics(predictions, win, best, experiment_id)
    importances = spark.createDataFrame(imp_rows, "fold int, model string, feature string, importance double")
    if strict:                                             # M10 on the results: bounded by the fold count
        bad = check_metrics(fold_results).count()
        flat = check_importances(importances).filter("all_zero").count()
        if bad or flat:
            raise ValueError(f"{bad} folds without usable metrics, {flat} folds whose importances are all zero")
    return TrainResult(predictions, fold_results, importances, scores, fitted)


# ---------------------------------------------------------------------------
# J14 experiment record, J17 permutation importance, J18 linear attribution, J19 store
# ---------------------------------------------------------------------------

def experiment_record(spark, experiment_id: str, models, feature_cols, params: Params, series_used=()) -> DataFrame:
    import datetime as dt
    row = (experiment_id, ",".join(models), {"tuner": params.tuner, "train_days": str(params.train_days),
                                             "test_days": str(params.test_days)},
           "trades", params.feature_version, "macro_series", len(feature_cols), list(series_used), None,
           params.seed, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    from quantspark.schemas import EXPERIMENTS
    return spark.createDataFrame([row], EXPERIMENTS)


def _partner(n: int, seed: int, inverse: bool = False):
    """A bijection of the positions 0..n-1 (or its inverse) as an expression: p -> (a p + b) mod n with a prime to n.

    Neighbours land at least n / 5 apart; seed and n alone decide, so reruns
    and other partitionings agree."""
    start = n // 5 + seed * 2654435761 % max(1, 3 * n // 5)
    a = next(v for v in itertools.count(start) if math.gcd(v, n) == 1)
    b = seed * 2654435761 * 40503 % n
    kind = "bigint" if n * n + n < 1 << 63 else "decimal(38,0)"
    if inverse:
        a = pow(a, -1, n)
        b = -a * b % n
    p = F.col(POS) if kind == "bigint" else F.col(POS).cast("decimal(19,0)")
    return F.pmod(p * F.lit(a) + F.lit(b), F.lit(n)).cast("bigint")


def permutation_importance(model: FittedModel, test: DataFrame, label: str = "pnl", repeats: int = 5,
                           seed: int = 42, order=None) -> DataFrame:
    """Mean drop of R^2 when one feature's values are permuted across rows.

    Rows are numbered once in ``order`` (time and id if the frame has them,
    else its values); each repeat maps positions by a computed bijection.  A
    linear model scores all p permuted features of all repeats in one join and
    one aggregation: every row sends its features to the row that takes them
    in each repeat, whose prediction changes by w_j * (x'_j - x_j).  Other
    models take one join a repeat and are re-scored once per feature.  Without
    rows all drops are 0.
    """
    cols = model.feature_cols
    if order is None:
        order = [c for c in ("trade_timestamp", "trade_id") if c in test.columns] or [*cols, label]
    if all(isinstance(c, str) for c in order):          # only what is read goes through the numbering
        test = test.select(*dict.fromkeys([*order, *cols, label]))
    base_pred = model.transform(test, "_pred")
    r2_base = regression_metrics(base_pred, label, "_pred").first()["r2"]
    orig = with_position(base_pred, list(order))
    whole = orig.agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("ybar")).first()
    drops = {c: [] for c in cols}
    n = whole["n"]
    if n and repeats and isinstance(model, LinearFitted):
        sent = orig.select(F.posexplode(F.array(*[_partner(n, seed + r, inverse=True) for r in range(repeats)]))
                           .alias("_repeat", POS), *[F.col(c).alias(f"_p_{c}") for c in cols])
        e = F.col(label) - F.col("_pred")
        got = (orig.select(POS, label, "_pred", *cols).join(sent, POS).groupBy("_repeat").agg(
            F.sum((F.col(label) - F.lit(whole["ybar"])) ** 2).alias("sst"),
            *[F.sum((e - F.lit(float(w)) * (F.col(f"_p_{c}") - F.col(c).cast("double"))) ** 2).alias(f"e{i}")
              for i, (c, w) in enumerate(zip(cols, model.model.w))]).collect())        # one row a repeat
        for row in got:
            for i, c in enumerate(cols):
                drops[c].append(r2_base - (1.0 - row[f"e{i}"] / row["sst"] if row["sst"] else 0.0))
    else:
        for r in range(repeats if n else 0):
            perm = orig.select(F.col(POS).alias("_at"), *[F.col(c).alias(f"_p_{c}") for c in cols])
            pair = orig.withColumn("_at", _partner(n, seed + r)).join(perm, "_at")
            for c in cols:
                shuffled = pair.drop(c).withColumnRenamed(f"_p_{c}", c)
                r2 = regression_metrics(model.transform(shuffled), label, "prediction").first()["r2"]
                drops[c].append(r2_base - r2)
    rows = [(c, float(sum(v) / len(v)) if v else 0.0) for c, v in drops.items()]
    return test.sparkSession.createDataFrame(rows, "feature string, importance double")


def linear_attribution(model: FittedModel, df: DataFrame) -> DataFrame:
    """Exact attributions of a linear model, coef_j * (x_j - mean x_j) in raw units -> mean |value|
    per feature."""
    coef = model.raw_coefficients()
    if coef is None:
        raise ValueError("linear attribution needs a linear model")
    cols = list(model.feature_cols)
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    means = x.agg(*[F.avg(k).alias(k) for k in cols]).first()
    out = x.agg(*[F.avg(F.abs(F.lit(coef[k]) * (F.col(k) - F.lit(means[k] or 0.0)))).alias(k) for k in cols])
    return out.select(F.explode(F.array(*[F.struct(F.lit(k).alias("feature"), F.col(k).alias("value"))
                                          for k in cols])).alias("_a")).select("_a.*")


def save_model(model: FittedModel, path: str) -> None:
    """A model of any kind under ``path``: its description, MLlib models beside it, the bases of a stack in
    folders of their own."""
    from pyspark.sql import SparkSession
    meta = {"name": model.name, "config": model.config, "feature_cols": model.feature_cols,
            "means": model.means, "stds": model.stds, "label": model.label,
            "cls": type(model.model).__name__}
    if isinstance(model, StackedFitted):
        bases, weights, intercept = model.model
        meta.update(cls="Stacked", weights=weights, intercept=intercept)
        for i, b in enumerate(bases):
            save_model(b, f"{path}/base_{i}")
    elif isinstance(model, BoostedFitted):
        meta["boosted"] = model.model.to_json()
    elif isinstance(model, LinearFitted):
        meta["solution"] = [float(model.model.intercept), *([float(x) for x in v] for v in (
            model.model.w, model.model.beta, model.model.mean, model.model.std))]
    else:
        model.model.write().overwrite().save(f"{path}/mllib")
    ss = SparkSession.getActiveSession()
    ss.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_model(path: str) -> FittedModel:
    import numpy as np
    from pyspark.ml.regression import RandomForestRegressionModel
    from pyspark.sql import SparkSession

    from quantspark.functions.linalg import LinearSolution
    ss = SparkSession.getActiveSession()
    meta = json.loads(ss.read.text(f"{path}/meta").first()[0])

    def made(cls, model):
        return cls(meta["name"], meta["config"], meta["feature_cols"], meta["means"], meta["stds"], model, meta["label"])

    if meta["cls"] == "Stacked":
        bases = [load_model(f"{path}/base_{i}") for i in range(len(meta["weights"]))]
        return made(StackedFitted, (bases, meta["weights"], meta["intercept"]))
    if "boosted" in meta:
        return made(BoostedFitted, boosting.Boosted.from_json(meta["boosted"]))
    if "solution" in meta:
        return made(LinearFitted, LinearSolution(meta["solution"][0], *map(np.array, meta["solution"][1:])))
    return made(FittedModel, RandomForestRegressionModel.load(f"{path}/mllib"))


def save_fold_models(result: TrainResult, root: str, experiment_id: str) -> list[str]:
    """Every fold's winner below ``root/experiment_id``.

    ``winners`` has one row per fold for every kind of model: linear winners
    with their weights in raw and standardised units, MLlib winners with the
    folder they are saved in.  The latest model is the row of the last fold.
    """
    base = f"{root.rstrip('/')}/{experiment_id}"
    paths, rows = [], []
    for k, m in result.models:
        linear = isinstance(m, LinearFitted)
        path = None if linear else f"{base}/fold_{k}"
        if path:
            save_model(m, path)
            paths.append(path)
        parts = [m.model.w, m.model.beta, m.model.mean, m.model.std] if linear else [None] * 4
        rows.append((int(k), m.name, json.dumps(m.config), list(m.feature_cols), m.label, path,
                     float(m.model.intercept) if linear else None,
                     *[None if p is None else [float(x) for x in p] for p in parts]))
    result.predictions.sparkSession.createDataFrame(
        rows, "fold int, model string, config string, features array<string>, label string, path string, "
              "intercept double, weights array<double>, beta array<double>, mean array<double>, std array<double>"
    ).coalesce(1).write.mode("overwrite").parquet(f"{base}/winners")
    return paths


def load_latest(root: str, experiment_id: str, fold: int | None = None) -> FittedModel:
    """The winner of the last fold (or of ``fold``), linear or not; a fold whose saved files are gone
    falls back to the fold before it.  Without any model FileNotFoundError is raised."""
    import numpy as np
    from pyspark.errors import AnalysisException
    from pyspark.sql import SparkSession

    from quantspark.functions.linalg import LinearSolution
    ss = SparkSession.getActiveSession()
    found = ss.read.parquet(f"{root.rstrip('/')}/{experiment_id}/winners")
    found = found if fold is None else found.filter(F.col("fold") <= fold)
    for r in found.orderBy(F.col("fold").desc()).collect():       # one row per fold
        if r["weights"] is None:
            try:
                return load_model(r["path"])
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
        w, beta, mean, std = (np.array(r[c]) for c in ("weights", "beta", "mean", "std"))
        return LinearFitted(r["model"], json.loads(r["config"]), list(r["features"]), None, None,
                            LinearSolution(r["intercept"], w, beta, mean, std), r["label"])
    raise FileNotFoundError(f"no saved model of experiment {experiment_id} below {root}")


def load_latest_linear(root: str, experiment_id: str) -> LinearFitted | None:
    """The latest winner if it is linear, else None."""
    m = load_latest(root, experiment_id)
    return m if isinstance(m, LinearFitted) else None


def persist_run(result: TrainResult, root: str, params: Params, feature_cols, experiment_id: str,
                series_used=(), save_models: bool = True) -> None:
    """Append a training run to the tables below ``root``: predictions and fold results
    (one partition per experiment, rewritten if it is run again), the experiment's record, the
    importances, and the fold winners."""
    from quantspark.sources.tables import write_table
    spark = result.predictions.sparkSession
    folds = result.fold_results
    write_table(result.predictions, root, "predictions", "overwrite")
    write_table(folds, root, "walk_forward_results", "overwrite")
    write_table(result.importances.withColumn("experiment_id", F.lit(experiment_id)), root, "importances",
                "overwrite", ["experiment_id"])
    models = sorted({name for name, in folds.select("best_model").distinct().collect()})   # one row per model
    write_table(experiment_record(spark, experiment_id, models, feature_cols, params, series_used), root,
                "experiments", "append")
    if save_models:
        save_fold_models(result, f"{root.rstrip('/')}/models", experiment_id)
