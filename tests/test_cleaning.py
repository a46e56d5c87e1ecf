from pyspark.sql import functions as F

from timestamps import ts
from quantspark.plans.cleaning import filter_accounts, quality_report, vwap_dedup
from quantspark.schemas import TRADES


def _trades(spark, rows):
    return spark.createDataFrame(rows, TRADES)


def test_vwap_merge_within_window(spark):
    rows = [
        (1, ts("2024-01-01 10:00:00.100"), "ACC_1", "BUY", 10.0, 100.0, 5.0, "P1", 1.0, 0.1),
        (2, ts("2024-01-01 10:00:00.200"), "ACC_1", "BUY", 20.0, 103.0, 10.0, "P1", 1.0, 0.1),
        (3, ts("2024-01-01 10:05:00"), "ACC_1", "BUY", 15.0, 105.0, -2.0, "P1", 1.0, 0.1),
    ]
    out = vwap_dedup(_trades(spark, rows), "500 milliseconds", num_blocks=2).orderBy("timestamp").collect()
    assert len(out) == 2
    assert abs(out[0]["price"] - 102.0) < 1e-9
    assert out[0]["quantity"] == 30.0 and out[0]["pnl"] == 15.0 and out[0]["id"] == 1
    assert out[1]["price"] == 105.0


def test_gap_of_exactly_the_window_merges(spark):
    rows = [(1, ts("2024-01-01 10:00:00.000"), "A", "BUY", 1.0, 1.0, 1.0, "P", 0.0, 0.0),
            (2, ts("2024-01-01 10:00:00.500"), "A", "BUY", 1.0, 3.0, 1.0, "P", 0.0, 0.0),
            (3, ts("2024-01-01 10:00:01.001"), "A", "BUY", 1.0, 5.0, 1.0, "P", 0.0, 0.0)]
    out = vwap_dedup(_trades(spark, rows), "500 milliseconds").orderBy("timestamp").collect()
    assert [r["quantity"] for r in out] == [2.0, 1.0]


def test_hot_group_split_over_blocks_matches_single_block(spark):
    # one (account, permutation) holds every row: the session scan must not depend on blocks
    base = spark.range(3000).select(
        F.col("id"), (F.lit(1_700_000_000) + F.col("id") * F.when(F.col("id") % 7 == 0, 2).otherwise(0.3))
        .cast("timestamp").alias("timestamp"), F.lit("HOT").alias("account"), F.lit("BUY").alias("direction"),
        F.lit(1.0).alias("quantity"), (F.col("id") % 13).cast("double").alias("price"),
        F.lit(1.0).alias("pnl"), F.lit("P").alias("permutation_id"), F.lit(0.0).alias("holding_time"),
        F.lit(0.0).alias("threshold"))
    a = sorted(tuple(r) for r in vwap_dedup(base, "1 second", num_blocks=1).collect())
    b = sorted(tuple(r) for r in vwap_dedup(base, "1 second", num_blocks=7).collect())
    assert a == b and len(a) > 1


def test_blocked_accounts_removed(spark):
    rows = [(1, ts("2024-01-01 10:00:00"), "ACC_1", "BUY", 1.0, 1.0, 1.0, "P", 0.0, 0.0),
            (2, ts("2024-01-01 10:00:01"), "ACC_TEST", "BUY", 1.0, 1.0, 1.0, "P", 0.0, 0.0),
            (3, ts("2024-01-01 10:00:02"), None, "BUY", 1.0, 1.0, 1.0, "P", 0.0, 0.0)]
    out = filter_accounts(_trades(spark, rows), ["ACC_TEST", "ACC_INVALID"]).collect()
    assert sorted(r["id"] for r in out) == [1, 3]


def test_quality_report(spark):
    rows = [(1, ts("2024-01-01 10:00:00"), "ACC_1", "BUY", 1.0, 1.0, 1.0, "P", 0.0, 0.0),
            (2, ts("2024-01-01 10:00:00.1"), "ACC_1", "BUY", 1.0, 1.0, 1.0, "P", 0.0, 0.0),
            (3, ts("2024-01-01 10:00:02"), "ACC_TEST", "BUY", 1.0, 1.0, 1.0, "P", 0.0, 0.0)]
    raw = _trades(spark, rows)
    filt = filter_accounts(raw, ["ACC_TEST"])
    r = quality_report(raw, filt, vwap_dedup(filt)).first()
    assert (r["rows_in"], r["rows_blocked"], r["rows_merged"], r["rows_out"]) == (3, 1, 1, 1)
