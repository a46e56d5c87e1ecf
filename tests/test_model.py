import datetime as dt
import tempfile

import numpy as np
from pyspark.sql import functions as F

from quantspark.config import Params
from quantspark.functions.linalg import block_moments, solve
from quantspark.plans import model as mdl
from quantspark.plans.diagnose import pacf_from_acf


def _data(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 3))
    y = 2.0 * X[:, 0] - X[:, 1] + 0.5 + rng.normal(scale=0.1, size=n)
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), "P", float(a), float(b), float(c), float(t))
            for i, ((a, b, c), t) in enumerate(zip(X, y))]
    return spark.createDataFrame(rows, "trade_id long, trade_timestamp timestamp, permutation_id string, "
                                       "a double, b double, c double, pnl double"), X, y


def test_gramian_ols_and_ridge_match_numpy(spark):
    df, X, y = _data(spark)
    m = block_moments(df, ["a", "b", "c"], "pnl", None, {"a": 0.1, "pnl": 0.2})[None]
    ols = solve(m, "linear_regression", {}, np.array([0.1, 0.0, 0.0]), 0.2)
    A = np.column_stack([np.ones(len(y)), X])
    coef = np.linalg.lstsq(A, y, rcond=None)[0]
    assert np.allclose(ols.w, coef[1:], atol=1e-9) and abs(ols.intercept - coef[0]) < 1e-9
    Z = (X - X.mean(0)) / X.std(0)
    b = np.linalg.solve(Z.T @ Z + 1.0 * np.eye(3), Z.T @ (y - y.mean()))
    ridge = solve(m, "ridge", {"alpha": 1.0}, np.array([0.1, 0.0, 0.0]), 0.2)
    assert np.allclose(ridge.beta, b, atol=1e-9)


def test_lasso_zeroes_noise_feature(spark):
    df, _, _ = _data(spark)
    m = mdl.fit_linear("lasso", {"alpha": 0.1}, df, ["a", "b", "c"])
    coef = m.coefficients()
    assert abs(coef["c"]) < 1e-6 and coef["a"] > 1.0


def test_walk_forward_with_stacking(spark):
    df, _, _ = _data(spark, n=600)
    p = Params(train_days=10, test_days=2, enable_stacking=True)
    res = mdl.train_walk_forward(df, p, models=("linear_regression", "ridge"), grids={"ridge": {"alpha": [1.0]}})
    assert res.predictions.count() > 0
    assert res.scores.filter(F.col("model") == "stacking").count() > 0
    fr = res.fold_results.collect()
    assert all(r["mae"] < 0.2 for r in fr)


def test_model_save_load(spark):
    df, _, _ = _data(spark)
    m = mdl.fit("random_forest", {"n_estimators": 5, "max_depth": 3}, df, ["a", "b", "c"])
    path = tempfile.mkdtemp(prefix="qs-model-", dir="/tmp") + "/m"
    mdl.save_model(m, path)
    m2 = mdl.load_model(path)
    a = [r["prediction"] for r in m.transform(df).orderBy("trade_id").collect()]
    b = [r["prediction"] for r in m2.transform(df).orderBy("trade_id").collect()]
    assert a == b


def test_pacf_durbin_levinson_ar1():
    phi = 0.6
    r = [phi ** k for k in range(6)]
    p = pacf_from_acf(r)
    assert abs(p[1] - phi) < 1e-12 and all(abs(x) < 1e-12 for x in p[2:])


def test_fold_winners_saved_and_reloaded(spark):
    df, _, _ = _data(spark, n=600)
    res = mdl.train_walk_forward(df, Params(train_days=10, test_days=2), models=("linear_regression",))
    root = tempfile.mkdtemp(prefix="qs-store-", dir="/tmp")
    mdl.save_fold_models(res, root, "e1")
    m = mdl.load_latest_linear(root, "e1")
    last = res.models[-1][1]
    a = [r["prediction"] for r in last.transform(df).orderBy("trade_id").limit(5).collect()]
    b = [r["prediction"] for r in m.transform(df).orderBy("trade_id").limit(5).collect()]
    assert np.allclose(a, b)


def test_partner_is_a_bijection(spark):
    for n, seed in ((1, 42), (2, 43), (7, 44), (100, 45), (997, 46)):
        got = [r[0] for r in spark.range(n).withColumnRenamed("id", mdl.POS).select(mdl._partner(n, seed)).collect()]
        assert sorted(got) == list(range(n))
    n = 5_000_000_011                                    # products beyond 64 bits
    far = spark.createDataFrame([(p,) for p in (0, 1, 2, n - 1)], f"{mdl.POS} bigint")
    got = [r[0] for r in far.select(mdl._partner(n, 42)).collect()]
    step = (got[1] - got[0]) % n
    assert (got[2] - got[1]) % n == step and (got[0] - got[3]) % n == step and all(0 <= x < n for x in got)


def test_permutation_importance_by_hand_and_on_any_partitioning(spark):
    df, X, y = _data(spark, n=120)
    model = mdl.fit_linear("linear_regression", {}, df, ["a", "b", "c"])
    got = {r["feature"]: r["importance"] for r in mdl.permutation_importance(model, df, repeats=3).collect()}
    again = {r["feature"]: r["importance"]
             for r in mdl.permutation_importance(model, df.repartition(7), repeats=3).collect()}
    w, b, n = model.model.w, model.model.intercept, len(y)
    base, sst = X @ w + b, ((y - y.mean())**2).sum()
    for j, c in enumerate("abc"):
        drops = []
        for r in range(3):
            at = [x[0] for x in spark.range(n).withColumnRenamed("id", mdl.POS).orderBy(mdl.POS)
                  .select(mdl._partner(n, 42 + r)).collect()]
            moved = base + w[j] * (X[at, j] - X[:, j])
            drops.append((((y - moved)**2).sum() - ((y - base)**2).sum()) / sst)
        assert np.isclose(got[c], np.mean(drops)) and np.isclose(got[c], again[c])
    assert got["a"] > got["b"] > abs(got["c"])
    none = mdl.permutation_importance(model, df.limit(0), repeats=2)
    assert [r["importance"] for r in none.collect()] == [0.0, 0.0, 0.0]


def test_linear_folds_are_scored_in_one_scan(spark, monkeypatch):
    df, X, y = _data(spark, n=600)
    p = Params(train_days=10, test_days=2)
    for limit in (mdl.COEFFICIENT_BYTES, 0):             # broadcast, and joined
        monkeypatch.setattr(mdl, "COEFFICIENT_BYTES", limit)
        res = mdl.train_walk_forward(df, p, models=("linear_regression", "ridge"), grids={"ridge": {"alpha": [1.0]}})
        assert len(res.models) > 2
        plan = res.predictions._jdf.queryExecution().optimizedPlan().toString()
        assert "Union" not in plan
        rows = {r["trade_id"]: r for r in res.predictions.collect()}
        folds = {r["fold"]: r for r in res.fold_results.collect()}
        assert len(rows) == sum(f["test_size"] for f in folds.values())
        for k, model in res.models:
            own = [r for r in rows.values() if r["walk_forward_fold"] == k]
            for r in own:
                assert folds[k]["test_start"] <= r["timestamp"] <= folds[k]["test_end"]
                assert np.isclose(r["predicted_pnl"], X[r["trade_id"]] @ model.model.w + model.model.intercept)


def test_noise_baseline_depends_on_ids_only(spark):
    from quantspark.plans.evaluate import hashed_normal
    df = spark.range(4000)
    a = {r["id"]: r["z"] for r in df.withColumn("z", hashed_normal(F.col("id"), 42)).collect()}
    b = {r["id"]: r["z"] for r in df.repartition(13).withColumn("z", hashed_normal(F.col("id"), 42)).collect()}
    z = np.array(list(a.values()))
    assert a == b and abs(z.mean()) < 0.06 and abs(z.std() - 1) < 0.05 and abs((z**3).mean()) < 0.2


def test_optimality_tells_solutions_from_others(spark):
    df, _, _ = _data(spark)
    for name, cfg in (("linear_regression", {}), ("ridge", {"alpha": 20.0}), ("lasso", {"alpha": 0.3}),
                      ("elasticnet", {"alpha": 0.3, "l1_ratio": 0.4})):
        m = mdl.fit_linear(name, cfg, df, ["a", "b", "c"])
        assert all(r["violation"] < 1e-7 for r in mdl.optimality(m, df).collect()), name
        m.model.w = m.model.w * 1.01
        m.model.beta = m.model.beta * 1.01
        assert max(r["violation"] for r in mdl.optimality(m, df).collect()) > 1e-3, name


def test_permutation_importance_joins_once_on_the_columns_it_reads(spark, monkeypatch):
    df, _, _ = _data(spark, n=60)
    model = mdl.fit_linear("linear_regression", {}, df, ["a", "b", "c"])
    numbered, real, joins, join = [], mdl.with_position, [], type(df).join
    monkeypatch.setattr(mdl, "with_position", lambda x, order: (numbered.append(x.columns), real(x, order))[1])
    monkeypatch.setattr(type(df), "join", lambda x, other, on=None, how=None: (joins.append(on), join(x, other, on, how))[1])
    mdl.permutation_importance(model, df.withColumn("wide", F.lit("not read")), repeats=4)
    assert "wide" not in numbered[0] and joins.count(mdl.POS) == 1 and "_at" not in joins


def test_inverse_partner_undoes_the_partner(spark):
    for n, seed in ((1, 42), (7, 44), (997, 46), (5_000_000_011, 42)):
        rows = spark.createDataFrame([(p,) for p in {0, 1 % n, n // 2, n - 1}], f"{mdl.POS} bigint")
        there = rows.select(F.col(mdl.POS).alias("p"), mdl._partner(n, seed).alias(mdl.POS))
        assert all(r["p"] == r["q"] for r in there.select("p", mdl._partner(n, seed, inverse=True).alias("q")).collect())


def test_importance_is_fitted_on_the_stored_matrix(spark, monkeypatch):
    from quantspark import catalog
    plans = []

    def seen(name, cfg, df, cols, *rest):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        raise KeyboardInterrupt

    monkeypatch.setattr(mdl, "fit_linear", seen)
    try:
        catalog.QUERIES["j17_permutation_importance"](spark, "/root/testdata/sf0.001")
    except KeyboardInterrupt:
        pass
    assert plans and not any(w in plans[0] for w in ("Window", "Join", "InMemoryRelation"))
