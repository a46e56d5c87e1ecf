"""Leaf-wise boosting against hand-made functions and plain recomputation."""

import numpy as np
import pytest

from quantspark.plans import boosting


def _frame(spark, X, y):
    return spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(X, y)],
                                 ", ".join(f"x{j} double" for j in range(X.shape[1])) + ", pnl double")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    X = np.column_stack([rng.integers(0, 12, 400), rng.integers(0, 9, 400), rng.integers(0, 20, 400)]).astype(float)
    y = np.where(X[:, 0] <= 4, 3.0, np.where(X[:, 1] <= 2, -5.0, 1.0)) + 0.3 * rng.normal(size=400)
    return _frame(spark, X, y).cache(), X, y


def _plain(X, y, trees, num_leaves, max_depth, l2, rate):
    """The same boosting, leaf by leaf, over all values of all features."""
    pred = np.full(len(y), y.mean())
    for _ in range(trees):
        r, leaves = y - pred, [(np.ones(len(y), dtype=bool), 0)]

        def best(rows):
            out = (1e-9, None)
            for j in range(X.shape[1]):
                for v in np.unique(X[rows, j])[:-1]:
                    a, b = rows & (X[:, j] <= v), rows & (X[:, j] > v)
                    gain = (r[a].sum()**2 / (a.sum() + l2) + r[b].sum()**2 / (b.sum() + l2)
                            - r[rows].sum()**2 / (rows.sum() + l2))
                    if gain > out[0] + 1e-9:
                        out = (gain, (a, b))
            return out

        while len(leaves) < num_leaves:
            found = [(best(rows) if d < max_depth else (0, None)) for rows, d in leaves]
            at = max(range(len(leaves)), key=lambda i: found[i][0] if found[i][1] else 0)
            if found[at][1] is None:
                break
            d = leaves.pop(at)[1]
            leaves += [(side, d + 1) for side in found[at][1]]
        for rows, _ in leaves:
            pred[rows] += rate * r[rows].sum() / (rows.sum() + l2)
    return pred


def _predicted(model, df):
    return np.array([r[0] for r in df.select(model.expr(["x0", "x1", "x2"])).collect()])


def test_step_function_is_found(spark):
    X = np.array([[i % 10, i % 7, 0] for i in range(140)], dtype=float)
    y = np.where(X[:, 0] <= 3, 2.0, -1.0)
    df = _frame(spark, X, y)
    m = boosting.fit(df, ["x0", "x1", "x2"], "pnl", trees=1, num_leaves=2, l2=0.0, learning_rate=1.0)
    t = m.trees[0]
    assert (t.feature[0], t.threshold[0], len(t.feature)) == (0, 3.0, 3)
    assert np.allclose(_predicted(m, df), y) and m.importance().tolist() == [1.0, 0.0, 0.0]


def test_equals_leaf_by_leaf_growth(data, monkeypatch):
    df, X, y = data
    monkeypatch.setattr(boosting, "STORED_EVERY", 2)
    for leaves, depth, l2 in ((4, 6, 1.0), (6, 2, 0.0), (7, 5, 3.0)):
        m = boosting.fit(df, ["x0", "x1", "x2"], "pnl", trees=3, num_leaves=leaves, max_depth=depth, l2=l2, learning_rate=0.5)
        assert np.allclose(_predicted(m, df), _plain(X, y, 3, leaves, depth, l2, 0.5)), (leaves, depth)


def test_parameters_change_the_fit_and_reruns_agree(data):
    df, X, y = data
    run = lambda d=df, **k: _predicted(boosting.fit(d, ["x0", "x1", "x2"], "pnl", trees=3, **k), df)
    plain = run()
    assert np.allclose(plain, run(df.repartition(5)))
    half = run(subsample=0.5)
    assert np.allclose(half, run(df.repartition(5), subsample=0.5))
    for other in (half, run(num_leaves=3), run(l2=20.0), run(colsample=0.3), run(max_depth=1), run(min_rows=90)):
        assert not np.allclose(plain, other)


def test_empty_null_and_constant(spark):
    schema = "x0 double, x1 double, x2 double, pnl double"
    cols = ["x0", "x1", "x2"]
    assert _predicted(boosting.fit(spark.createDataFrame([], schema), cols, "pnl"),
                      spark.createDataFrame([(1.0, 2.0, 3.0, 0.0)], schema)).tolist() == [0.0]
    same = spark.createDataFrame([(1.0, None, 3.0, 2.0), (1.0, None, 3.0, 4.0), (1.0, None, 3.0, None)], schema)
    assert _predicted(boosting.fit(same, cols, "pnl", trees=2), same).tolist() == [3.0] * 3
    odd = spark.createDataFrame([(None, 1.0, 0.0, 5.0), (float("nan"), 1.0, 0.0, 5.0), (1.0, 1.0, 0.0, 1.0),
                                 (2.0, 1.0, 0.0, 1.0)], schema)
    m = boosting.fit(odd, cols, "pnl", trees=1, num_leaves=2, l2=0.0, learning_rate=1.0)
    assert m.trees[0].feature[0] == 0
    assert boosting.Boosted.from_json(m.to_json()).to_json() == m.to_json()


def _matrix(spark, n=500, seed=1):
    rng = np.random.default_rng(seed)
    X = rng.integers(0, 10, size=(n, 2)).astype(float)
    y = np.where(X[:, 0] <= 4, 3.0, -2.0) + 0.5 * X[:, 1] + 0.1 * rng.normal(size=n)
    rows = [(i, min(4 * i // n, 3), float(a), float(b), float(v)) for i, ((a, b), v) in enumerate(zip(X, y))]
    return spark.createDataFrame(rows, "trade_id long, cv_block int, x0 double, x1 double, pnl double"), y


def test_presets_take_their_own_parameters(spark):
    from quantspark.plans import model as mdl
    df, _ = _matrix(spark, 200)

    def run(name, **cfg):
        m = mdl.fit(name, {"n_estimators" if name != "catboost" else "iterations": 2, **cfg}, df, ["x0", "x1"])
        return np.array([r["prediction"] for r in m.transform(df).orderBy("trade_id").collect()])

    assert not np.allclose(run("lightgbm"), run("lightgbm", num_leaves=3))
    assert not np.allclose(run("catboost", l2_leaf_reg=1), run("catboost", l2_leaf_reg=50))
    assert not np.allclose(run("xgboost"), run("xgboost", colsample_bytree=0.5))
    with pytest.raises(KeyError):
        run("xgboost", no_such_parameter=1)


def test_stacking_over_trees_and_linear_models(spark, tmp_path):
    from quantspark.plans import model as mdl
    df, y = _matrix(spark)
    base = [("ridge", {"alpha": 1.0}), ("xgboost", {"n_estimators": 6, "max_depth": 2, "learning_rate": 0.6}),
            ("random_forest", {"n_estimators": 3, "max_depth": 3})]
    mae, m = mdl.stack(df, ["x0", "x1"], "pnl", base)
    pred = lambda x: np.array([r["prediction"] for r in x.transform(df).orderBy("trade_id").collect()])
    alone = pred(mdl.fit(*base[0], df, ["x0", "x1"]))
    got = pred(m)
    assert mae < 0.5 * np.abs(alone - y).mean() and np.abs(got - y).mean() < 0.5 * np.abs(alone - y).mean()
    assert np.isclose(sum(m.native_importance().values()), 1.0)
    mdl.save_model(m, str(tmp_path / "stack"))
    assert np.allclose(pred(mdl.load_model(str(tmp_path / "stack"))), got)


def test_stack_of_linear_models_equals_the_closed_form(spark):
    from quantspark.plans import model as mdl
    df, _ = _matrix(spark)
    base = [("ridge", {"alpha": 5.0}), ("lasso", {"alpha": 0.1})]
    a, m = mdl.stack(df, ["x0", "x1"], "pnl", base)
    b, n = mdl.stack_linear(df, ["x0", "x1"], "pnl", base)
    rows = n.transform(m.transform(df, "one"), "two").collect()
    assert np.isclose(a, b) and np.allclose([r["one"] for r in rows], [r["two"] for r in rows])


def test_rows_are_stored_in_blocks(spark, data):
    df, X, y = data
    cuts = [np.unique(c)[:-1] for c in X.T]
    blocks = boosting._binned(df.coalesce(1), ["x0", "x1", "x2"], "pnl", cuts, 0.5).toArrow()
    assert blocks.num_rows == 1 < len(X)                 # one cell for 400 rows; a pass handles no row of its own
    (x, label, pred, _), = boosting._blocks(blocks.to_batches()[0], 3)
    at, own = np.lexsort([*x.T, label]), np.lexsort([*X.T, y])
    assert np.array_equal(x[at], X[own]) and np.array_equal(label[at], y[own]) and (pred == 0.5).all()


def test_models_on_the_same_rows_share_their_bins(data, monkeypatch):
    df, X, y = data
    cols, calls, real = ["x0", "x1", "x2"], [], boosting.binned
    alone = [_predicted(boosting.fit(df, cols, "pnl", trees=2, max_depth=d), df) for d in (2, 3)]
    ready = boosting.binned(df, cols, "pnl")
    monkeypatch.setattr(boosting, "binned", lambda *a: (calls.append(a), real(*a))[1])
    shared = [_predicted(boosting.fit(df, cols, "pnl", trees=2, max_depth=d, ready=ready), df) for d in (2, 3)]
    assert np.allclose(alone, shared) and not calls
