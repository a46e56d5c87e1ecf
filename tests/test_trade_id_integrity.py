import datetime as dt

from quantspark.plans.evaluate import integrity_report, prediction_checks, residuals


def test_predictions_join_trades_on_trade_id(spark):
    trades = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 10.0, "P1"), (2, dt.datetime(2024, 1, 2), -5.0, "P2")],
                                   "id long, timestamp timestamp, pnl double, permutation_id string")
    preds = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1), "P1", 1.0, 10.0, 0, "e"), (2, dt.datetime(2024, 1, 2), "P2", 2.0, -5.0, 0, "e")],
        "trade_id long, timestamp timestamp, permutation_id string, predicted_pnl double, actual_pnl double, "
        "walk_forward_fold int, experiment_id string")
    r = {x["trade_id"]: x["actual_pnl"] for x in residuals(preds, trades).collect()}
    assert r == {1: 10.0, 2: -5.0}
    rep = integrity_report(trades, preds).first()
    assert rep["passed"] and rep["joined_rows"] == 2 and rep["orphan_predictions"] == 0
    assert prediction_checks(preds).first()["passed"]
