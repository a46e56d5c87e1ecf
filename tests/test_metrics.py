import math

import pytest

from quantspark.plans.evaluate import regression_metrics, trading_metrics_dict


def test_regression_metrics(spark):
    df = spark.createDataFrame([(3.0, 2.5), (-0.5, 0.0), (2.0, 2.0), (7.0, 8.0)], "y double, yhat double")
    r = regression_metrics(df, "y", "yhat").first()
    assert abs(r["mae"] - 0.5) < 1e-12
    assert abs(r["rmse"] - math.sqrt(0.375)) < 1e-12


def test_trading_metrics(spark):
    vals = [1.0, 2.0, -1.0, 3.0, -2.0, 1.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, r double")
    m = trading_metrics_dict(df, "r", ["i"])
    assert abs(m["win_rate"] - 4 / 6) < 1e-12
    assert abs(m["profit_factor"] - 7 / 3) < 1e-12
    assert m["max_drawdown"] == -2.0
    assert m["omega_ratio"] == m["profit_factor"]


def test_trading_metrics_needs_two_rows(spark):
    df = spark.createDataFrame([], "i long, r double")
    with pytest.raises(ValueError):
        trading_metrics_dict(df, "r", ["i"])


def test_no_losses_gives_infinite_profit_factor(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0)], "i long, r double")
    assert trading_metrics_dict(df, "r", ["i"])["profit_factor"] == float("inf")
