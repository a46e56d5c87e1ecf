from pyspark.sql import functions as F

from quantspark.plans.recommend import best_per_slot, profiles, recommendation_matrix


def test_matrix_is_7_by_24(spark):
    rows = [(d, h, f"P{(d + h) % 3}", float(d * 24 + h)) for d in range(7) for h in range(24)]
    best = spark.createDataFrame(rows, "day_of_week int, hour_of_day int, best_permutation string, predicted_pnl double")
    m = recommendation_matrix(best).orderBy("day_of_week").collect()
    assert len(m) == 7 and len(m[0]) == 26
    assert m[0]["day"] == "Monday" and m[0]["00:00"] == "P0"


def test_best_per_slot_ties_and_nan(spark):
    rows = [(0, 0, "A", 0, 1.0), (0, 0, "B", 1, 1.0), (0, 1, "A", 0, float("nan")), (0, 1, "B", 1, -3.0)]
    s = spark.createDataFrame(rows, "day_of_week int, hour_of_day int, permutation_id string, perm_order int, "
                                    "prediction double")
    b = {(r["day_of_week"], r["hour_of_day"]): r["best_permutation"] for r in best_per_slot(s).collect()}
    assert b == {(0, 0): "A", (0, 1): "B"}


def test_profiles_fill_from_global_and_fallback(spark):
    import datetime as dt
    rows = [("A", 0, 0, 1.0, dt.datetime(2024, 1, 1)), ("A", 0, 0, 3.0, dt.datetime(2024, 1, 1)),
            ("B", 0, 1, 10.0, dt.datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, "permutation_id string, day_of_week int, hour_of_day int, f double, "
                                     "trade_timestamp timestamp")
    p = {(r["permutation_id"], r["day_of_week"], r["hour_of_day"]): r["f"]
         for r in profiles(df, ["day_of_week", "f", "hour_of_day"]).collect()}
    assert len(p) == 2 * 168
    assert p[("A", 0, 0)] == 2.0 and p[("A", 0, 1)] == 10.0  # own slot, then global slot
    assert p[("A", 3, 5)] == 6.0  # slot absent globally: mean over A's filled global slots
