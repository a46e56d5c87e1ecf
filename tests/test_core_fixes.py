"""Trials of single operators: CSV binding, stores, ties, attributions, caps that must not exist."""

import datetime as dt
import json
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantspark.config import Params
from quantspark.plans import diagnose as dg
from quantspark.plans import evaluate as ev
from quantspark.plans import model as mdl
from quantspark.plans.features import macro_stream
from quantspark.plans.selection import training_summary
from quantspark.sources import tables as tb


def _csv(text):
    d = tempfile.mkdtemp(prefix="qs-csv-", dir="/tmp")
    with open(f"{d}/t.csv", "w") as f:
        f.write(text)
    return f"{d}/t.csv"


def test_csv_binds_by_name_and_fills_ids(spark):
    p = _csv("timestamp,account,direction,price,quantity,pnl,permutation_id\n"
             "2024-01-01 10:00:00,A,BUY,100,10,5,P1\n2024-01-01 10:00:01,A,BUY,101,20,,P1\n")
    rows = tb.read_trades_csv(spark, p).orderBy("timestamp").collect()
    assert [(r["price"], r["quantity"], r["pnl"]) for r in rows] == [(100.0, 10.0, 5.0), (101.0, 20.0, None)]
    assert [r["id"] for r in rows] == [1, 2] and rows[0]["threshold"] is None


def test_csv_faults_are_errors_or_rejects(spark):
    with pytest.raises(ValueError):
        tb.read_trades_csv(spark, _csv("id,timestamp,colour\n1,2024-01-01,red\n"))
    p = _csv("id,timestamp,price\n1,2024-01-01,5\n2,yesterday,6\n3,2024-01-02,x\n")
    with pytest.raises(Exception, match="unreadable trade"):
        tb.read_trades_csv(spark, p).collect()
    bad = tb.read_trades_csv(spark, p, rejects=True).collect()
    assert sorted(tuple(r["columns"]) for r in bad) == [("price",), ("timestamp",)]


def test_every_table_is_readable_after_initialisation(spark):
    root = tempfile.mkdtemp(prefix="qs-wh-", dir="/tmp")
    assert not tb.table_exists(spark, root, "trades")
    tb.initialize_schema(spark, root)
    assert len(tb.TABLES) == 7
    for name, schema in tb.TABLES.items():
        assert tb.table_exists(spark, root, name)
        got = tb.read_table(spark, root, name)
        assert got.count() == 0 and got.columns == schema.fieldNames()
    tb.initialize_schema(spark, root)        # once more: nothing is rewritten


def test_summary_ties_go_to_the_first_winner(spark):
    rows = [(k, m, 1.0, 1.0, 0.1) for k, m in enumerate(["ridge", "lasso", "linear_regression", "lasso", "ridge"])]
    s = training_summary(spark.createDataFrame(rows, "fold int, best_model string, mae double, rmse double, r2 double")).first()
    assert s["most_selected_model"] == "ridge"
    assert json.loads(s["model_selection_counts"]) == {"ridge": 2, "lasso": 2, "linear_regression": 1}


def _data(spark, n=600):
    rng = np.random.default_rng(1)
    a, b = rng.normal(scale=5.0, size=n), rng.normal(scale=1e-2, size=n)
    y = a + 200.0 * b
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), "P", float(u), float(v), float(t))
            for i, (u, v, t) in enumerate(zip(a, b, y))]
    return spark.createDataFrame(rows, "trade_id long, trade_timestamp timestamp, permutation_id string, a double, "
                                       "b double, pnl double"), a, b


def test_attributions_are_in_raw_units(spark):
    df, a, b = _data(spark)
    want = {"a": np.abs(a - a.mean()).mean(), "b": 200.0 * np.abs(b - b.mean()).mean()}
    m = mdl.fit_linear("linear_regression", {}, df, ["a", "b"])
    got = {r["feature"]: r["value"] for r in mdl.linear_attribution(m, df).collect()}
    assert got == pytest.approx(want, rel=1e-6)
    m2 = mdl.fit("linear_regression", {}, df, ["a", "b"])
    got = {r["feature"]: r["value"] for r in mdl.linear_attribution(m2, df).collect()}
    assert got == pytest.approx(want, rel=1e-6)


def test_latest_model_is_the_last_fold_whatever_its_kind(spark):
    df, _, _ = _data(spark, 200)
    lin = mdl.fit_linear("ridge", {"alpha": 1.0}, df, ["a", "b"])
    tree = mdl.fit("random_forest", {"n_estimators": 3, "max_depth": 3}, df, ["a", "b"])
    root = tempfile.mkdtemp(prefix="qs-store-", dir="/tmp")

    class Run:
        predictions = df
        models = [(0, lin), (1, tree)]
    mdl.save_fold_models(Run, root, "e")
    assert mdl.load_latest(root, "e").name == "random_forest"
    assert mdl.load_latest_linear(root, "e") is None
    back = mdl.load_latest(root, "e", fold=0)
    assert back.native_importance() == pytest.approx(lin.native_importance())
    Run.models = [(0, tree), (1, lin)]
    mdl.save_fold_models(Run, root, "e")
    assert mdl.load_latest(root, "e").name == "ridge"
    Run.models = [(0, lin), (7, tree)]
    mdl.save_fold_models(Run, root, "f")
    gone = spark.read.parquet(f"{root}/f/winners").withColumn("path", F.when(F.col("path").isNotNull(), F.lit(f"{root}/no")))
    gone = spark.createDataFrame(gone.collect(), gone.schema)
    gone.write.mode("overwrite").parquet(f"{root}/f/winners")
    assert mdl.load_latest(root, "f").name == "ridge"


def test_run_is_persisted(spark):
    df, _, _ = _data(spark)
    p = Params(train_days=10, test_days=2)
    res = mdl.train_walk_forward(df, p, models=("linear_regression",), experiment_id="e9", strict=True)
    root = tempfile.mkdtemp(prefix="qs-run-", dir="/tmp")
    mdl.persist_run(res, root, p, ["a", "b"], "e9")
    assert tb.read_table(spark, root, "predictions").filter("experiment_id = 'e9'").count() == res.predictions.count()
    assert tb.read_table(spark, root, "walk_forward_results").count() == res.fold_results.count() > 0
    assert tb.read_table(spark, root, "experiments").first()["model"] == "linear_regression"
    assert mdl.load_latest(f"{root}/models", "e9").name == "linear_regression"


def test_training_refuses_unusable_data(spark):
    df, _, _ = _data(spark, 100)
    with pytest.raises(ValueError):
        mdl.train_walk_forward(df.withColumn("a", F.lit(float("inf"))), Params(train_days=2, test_days=1))
    with pytest.raises(ValueError):
        mdl.train_walk_forward(df.withColumn("pnl", F.lit(1.0)), Params(train_days=2, test_days=1))
    with pytest.raises(ValueError):
        mdl.make_estimator("random_forest", {"max_depth": 31}, 10, 1.0, 1, "pnl")


def test_grid_has_distinct_configurations_only():
    for name, n in (("lightgbm", 324), ("catboost", 81), ("xgboost", 108)):
        assert len(mdl.grid(name, mdl.DEFAULT_GRIDS)) == n


def test_vif_has_a_row_for_every_feature(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 60))
    cols = [f"f{i}" for i in range(60)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in cols))
    vif = dg.collinearity(df, cols)[2]
    assert vif.count() == 60 and vif.filter("vif < 1 or vif > 2").count() == 0


def test_ewma_sees_the_whole_past(spark):
    n = 4000                                              # more than one block of the recurrence
    rng = np.random.default_rng(2)
    values = np.exp(np.cumsum(rng.normal(scale=0.02, size=n)))
    rows = [("DGS10", dt.date(2000, 1, 1) + dt.timedelta(days=i), float(v),
             dt.datetime(2000, 1, 1) + dt.timedelta(days=i)) for i, v in enumerate(values)]
    s = spark.createDataFrame(rows, "series_id string, date date, value double, release_date timestamp")
    got = [r["macro_ewma"] for r in macro_stream(s).orderBy("date").select("macro_ewma").collect()]
    x = np.concatenate([[0.0], values[1:] / values[:-1] - 1.0])
    b, num, den, want = 1 - 2 / 13, 0.0, 0.0, []
    for v in x:
        num, den = v + b * num, 1 + b * den
        want.append(num / den)
    assert np.allclose(got, want, rtol=1e-9, atol=1e-15)


def test_metrics_by_group_without_a_join(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0), (0, 3.0, 2.0), (1, 5.0, 5.0)], "g int, actual_pnl double, predicted_pnl double")
    out = ev.regression_metrics(df, by=["g"])
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    r = {x["g"]: x for x in out.collect()}
    assert r[0]["r2"] == pytest.approx(0.5) and r[1]["r2"] == 1.0


def test_series_correlation_mirrors_pairs(spark):
    rows = [(s, dt.date(2024, 1, 1) + dt.timedelta(days=i), 1e9 + f(i)) for s, f in
            (("a", float), ("b", lambda i: -2.0 * i), ("c", lambda i: float(i * i % 7)), ("k", lambda i: 0.0)) for i in range(20)]
    out = ev.series_correlation(spark.createDataFrame(rows, "series_id string, date date, value double")).collect()
    got = {(r["series_a"], r["series_b"]): r["corr"] for r in out}
    assert len(got) == 12 and got["a", "b"] == pytest.approx(-1.0) == got["b", "a"] and got["a", "k"] is None
