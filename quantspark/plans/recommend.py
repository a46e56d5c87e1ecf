"""Recommendation of the best permutation per (weekday, hour) (K1-K7).

Profiles are grouped means; the candidate grid is every permutation x the
168 weekly slots (generated by ``explode``, so it grows with the number of
permutations only); scoring is one distributed ``transform``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
SLOT_KEYS = ["day_of_week", "hour_of_day"]


def permutation_order(data: DataFrame, ts: str = "trade_timestamp") -> DataFrame:
    """First-seen order of permutations: their first trade time (ties: the id)."""
    return data.filter(F.col("permutation_id").isNotNull()).groupBy("permutation_id").agg(
        F.min(ts).alias("first_seen"))


def profiles(data: DataFrame, feature_cols: list[str]) -> DataFrame:
    """K1-K3: one feature vector per (permutation, day_of_week, hour_of_day) of the weekly grid.

    K1 global mean per slot; K2 permutation mean per slot, missing values
    filled from the global profile on the global slots; K3 a slot absent
    globally takes the permutation's mean over its filled global slots;
    day/hour are overwritten by the slot and remaining nulls become 0.
    """
    vals = [c for c in feature_cols if c not in SLOT_KEYS]
    glob = data.groupBy(*SLOT_KEYS).agg(*[F.avg(c).alias(c) for c in vals]).withColumn("_g", F.lit(True))
    perm = data.filter(F.col("permutation_id").isNotNull()).groupBy("permutation_id", *SLOT_KEYS).agg(
        *[F.avg(c).alias(c) for c in vals])
    perms = permutation_order(data)
    slots = perms.select("permutation_id", "first_seen", F.explode(F.sequence(F.lit(0), F.lit(167))).alias("_s"))
    slots = slots.select("permutation_id", "first_seen", (F.col("_s") / 24).cast("int").alias("day_of_week"),
                         (F.col("_s") % 24).cast("int").alias("hour_of_day"))
    g = glob.select(*SLOT_KEYS, "_g", *[F.col(c).alias(f"g_{c}") for c in vals])
    p = perm.select("permutation_id", *SLOT_KEYS, *[F.col(c).alias(f"p_{c}") for c in vals])
    x = slots.join(F.broadcast(g), SLOT_KEYS, "left").join(p, ["permutation_id", *SLOT_KEYS], "left")
    x = x.withColumns({f"f_{c}": F.when(F.col("_g"), F.coalesce(F.col(f"p_{c}"), F.col(f"g_{c}"))) for c in vals})
    w = Window.partitionBy("permutation_id")  # one group = at most 168 slots of one permutation
    x = x.withColumns({c: F.coalesce(F.col(f"f_{c}"), F.avg(f"f_{c}").over(w), F.lit(0.0)) for c in vals})
    out = x.select("permutation_id", "first_seen", *SLOT_KEYS, *vals)
    out = out.withColumns({"day_of_week": F.col("day_of_week"), "hour_of_day": F.col("hour_of_day")})
    return out


def score_grid(prof: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """K4 + K5: the candidate grid is ``prof`` itself; ``scorer`` adds ``prediction``."""
    return scorer(prof)


def best_per_slot(scored: DataFrame, pred: str = "prediction") -> DataFrame:
    """K6: highest prediction per slot; ties -> first-seen permutation (by ``first_seen`` and id, or by a
    given ``perm_order``); NaN never wins."""
    ok = scored.filter(F.col(pred).isNotNull() & ~F.isnan(F.col(pred)))
    order = ["perm_order"] if "perm_order" in scored.columns else ["first_seen", "permutation_id"]
    w = Window.partitionBy(*SLOT_KEYS).orderBy(F.col(pred).desc(), *order)
    best = ok.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
    return best.select(*SLOT_KEYS, F.col("permutation_id").alias("best_permutation"),
                       F.col(pred).alias("predicted_pnl"))


def recommendation_matrix(best: DataFrame) -> DataFrame:
    """K7: 7 x 24 matrix of best permutations, rows labelled by day, columns HH:00."""
    spark = best.sparkSession
    wide = best.groupBy("day_of_week").pivot("hour_of_day", list(range(24))).agg(F.first("best_permutation"))
    days = spark.range(7).select(F.col("id").cast("int").alias("day_of_week"))
    m = days.join(wide, "day_of_week", "left")
    label = F.element_at(F.array(*[F.lit(d) for d in DAYS]), F.col("day_of_week") + 1)
    return m.select(label.alias("day"), "day_of_week",
                    *[F.col(str(h)).alias(f"{h:02d}:00") for h in range(24)])
