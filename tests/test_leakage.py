import datetime as dt

from pyspark.sql import functions as F

from quantspark.config import Params
from quantspark.plans.folds import assign_folds, check_folds, cv_blocks, valid_folds


def _daily(spark, n=10):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "trade_id long, timestamp timestamp, pnl double")


def test_folds_are_leak_free(spark):
    p = Params(train_days=3, test_days=1, min_train_rows=1)
    a = assign_folds(_daily(spark), "timestamp", p)
    chk = check_folds(a).collect()
    assert len(chk) > 0
    assert not any(r["leak"] for r in chk)
    assert all(r["max_train_ts"] < r["min_test_ts"] for r in chk)


def test_fold_candidates_and_size_filter(spark):
    p = Params(train_days=3, test_days=1, min_train_rows=10)
    assert valid_folds(_daily(spark), "timestamp", p).count() == 0
    p = Params(train_days=3, test_days=1, min_train_rows=3)
    f = valid_folds(_daily(spark), "timestamp", p).orderBy("walk_forward_fold").collect()
    # starts 0..6: test end = start + 4 d <= day 9 + 1 s
    assert [r["walk_forward_fold"] for r in f] == list(range(6))
    assert all(r["train_size"] == 3 and r["test_size"] == 1 for r in f)


def test_cv_blocks_follow_time_series_split(spark):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), 0) for i in range(13)]
    df = spark.createDataFrame(rows, "trade_id long, timestamp timestamp, walk_forward_fold int")
    b = [r["cv_block"] for r in cv_blocks(df).orderBy("trade_id").collect()]
    # n = 13, k = 3: validation blocks are positions 4-6, 7-9, 10-12
    assert b == [0] * 4 + [1] * 3 + [2] * 3 + [3] * 3
