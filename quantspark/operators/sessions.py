"""Gap-based sessions over an ordered, grouped stream (skew-safe).

A session is a maximal run of rows of one group whose consecutive
timestamps are at most ``gap`` apart.  Instead of shuffling each group to a
single task (``session_window`` or ``Window.partitionBy(group)``), the
stream is range-partitioned on (group, order): a hot group is spread over
many blocks.  The previous row of a block's first row comes from the
previous non-empty block (one row per block), and the session number is a
global prefix count of session starts (block totals + carry-in).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantspark.operators.ordered import BLK, IDX, ranged


def session_ids(df: DataFrame, group: Sequence[str], order: Sequence[str], ts: str,
                gap_us: int, out: str = "_session", num_blocks: int | None = None) -> DataFrame:
    """Add ``out``: a global session number (same value = same session).

    New session when the previous row (in (group, order)) belongs to another
    group or its timestamp is more than ``gap_us`` microseconds earlier.
    """
    group, order = list(group), list(order)
    rng = ranged(df, [*group, *order], num_blocks)
    key = F.struct(*[F.col(g).alias(g) for g in group], F.col(ts).alias("_ts"))
    last = rng.groupBy(BLK).agg(F.max_by(key, F.col(IDX)).alias("_last"))
    wb = Window.orderBy(BLK)  # one row per non-empty block
    prev_last = last.select(BLK, F.lag("_last").over(wb).alias("_pl"))
    w = Window.partitionBy(BLK).orderBy(IDX)
    x = rng.join(F.broadcast(prev_last), BLK, "left")
    prev = F.when(F.col(IDX) == 0, F.col("_pl")).otherwise(F.lag(key).over(w))
    x = x.withColumn("_prev", prev)
    same_group = F.lit(True)
    for g in group:
        same_group = same_group & F.col("_prev")[g].eqNullSafe(F.col(g))
    gap_ok = (F.unix_micros(F.col(ts)) - F.unix_micros(F.col("_prev")["_ts"])) <= gap_us
    x = x.withColumn("_new", F.when(F.col("_prev").isNull() | ~same_group | ~F.coalesce(gap_ok, F.lit(False)),
                                    1).otherwise(0))
    tot = x.groupBy(BLK).agg(F.sum("_new").alias("_t"))
    carry = tot.select(BLK, F.coalesce(F.sum("_t").over(
        Window.orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_c"))
    x = x.join(F.broadcast(carry), BLK, "left")
    x = x.withColumn(out, F.col("_c") + F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.drop("_prev", "_pl", "_new", "_c", BLK, IDX)


def interval_us(spec: str) -> int:
    """'500 milliseconds' / '1 hour' / '2 seconds' -> microseconds."""
    n, unit = spec.split()
    unit = unit.lower().rstrip("s")
    scale = {"microsecond": 1, "millisecond": 1000, "second": 10**6, "minute": 60 * 10**6,
             "hour": 3600 * 10**6, "day": 86400 * 10**6}[unit]
    return int(float(n) * scale)
