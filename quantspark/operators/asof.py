"""As-of join by bucketed, disjoint time intervals.

The right side is one row per distinct event time r_k with a payload and the
next event time r_{k+1}.  Row k owns the half-open interval (r_k, r_{k+1}].  Each interval is exploded over the time buckets it
touches, each left row gets its bucket, and the two are equi-joined on the
bucket with the interval test as residual.  Intervals are disjoint, so a left row matches at
most one interval: for a left time t the match is the latest r_k < t
(strictly before) and r_{k+1} is the first event at or after t.

The right side is broadcast only when its exploded rows times the row width
stay below ``broadcast_bytes``; beyond it the join shuffles on the bucket and
AQE splits hot buckets.  Times up to the first event and after the last one
need no join: their answer is the same for all of them, and they are spread
over buckets that no interval has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20


def _row_bytes(df: DataFrame) -> int:
    """Width of a row by its schema (the default sizes Spark's own estimates use) plus the row header."""
    return 16 + sum(8 if f.dataType.simpleString() not in ("string", "binary") else 40 for f in df.schema.fields)


def _bucket(ts, seconds: int):
    return F.floor(F.unix_seconds(ts) / F.lit(seconds)).cast("long")


def asof_join(left: DataFrame, left_ts: str, events: DataFrame, event_ts: str, next_ts: str,
              payload: list[str], bucket_seconds: int = 86400,
              broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Left join every row of ``left`` to the last event strictly before ``left_ts``.

    ``events`` has one row per distinct ``event_ts`` with ``next_ts`` (the
    following event time, NULL for the last) and ``payload`` columns.  Adds
    ``_asof_prev`` (matched event time, NULL if none) and ``_asof_next``
    (first event time >= left_ts, NULL if none) plus the payload columns.
    """
    # Epoch microseconds: no driver-side time-zone conversion of the bounds.
    bounds = events.agg(F.unix_micros(F.min(event_ts)).alias("lo"), F.unix_micros(F.max(event_ts)).alias("hi"),
                        F.count(F.lit(1)).alias("n")).first()
    if bounds is None or bounds["lo"] is None:
        nulls = {c: F.lit(None).cast(events.schema[c].dataType) for c in payload}
        nulls["_asof_prev"] = F.lit(None).cast("timestamp")
        nulls["_asof_next"] = F.lit(None).cast("timestamp")
        return left.withColumns(nulls)
    lo_b, hi_b = bounds["lo"] // 10**6 // bucket_seconds, bounds["hi"] // 10**6 // bucket_seconds
    last = events.filter(F.unix_micros(event_ts) == bounds["hi"]).select(*payload).first()
    # The last event's interval has no end and is answered without the join.
    intervals = events.filter(F.col(next_ts).isNotNull()).select(
        F.col(event_ts).alias("_asof_prev"), F.col(next_ts).alias("_asof_next"), *payload)
    exploded = intervals.withColumn("_asof_b", F.explode(F.sequence(
        _bucket(F.col("_asof_prev"), bucket_seconds), _bucket(F.col("_asof_next"), bucket_seconds))))
    # Size check of the small side before broadcasting it.  The intervals are
    # contiguous, so their bucket spans telescope: rows = (hi_b - lo_b) + intervals.
    n = (hi_b - lo_b) + bounds["n"]
    right = F.broadcast(exploded) if n * _row_bytes(exploded) <= broadcast_bytes else exploded
    t = F.col(left_ts)
    us = F.unix_micros(t)
    before, after = us <= bounds["lo"], us > bounds["hi"]
    spread = F.lit(hi_b + 1) + F.pmod(F.xxhash64(us), F.lit(1 << 16))
    l2 = left.withColumn("_asof_lb", F.when(before | after, spread).otherwise(_bucket(t, bucket_seconds)))
    cond = ((l2["_asof_lb"] == exploded["_asof_b"]) & (t > exploded["_asof_prev"]) & (t <= exploded["_asof_next"]))
    j = l2.join(right, cond, "left").drop("_asof_lb", "_asof_b")
    fixed = {"_asof_prev": F.when(after, F.timestamp_micros(F.lit(bounds["hi"]))).otherwise(F.col("_asof_prev")),
             "_asof_next": F.when(before, F.timestamp_micros(F.lit(bounds["lo"]))).otherwise(F.col("_asof_next"))}
    for c in payload:
        fixed[c] = F.when(after, F.lit(last[c]).cast(events.schema[c].dataType)).otherwise(F.col(c))
    return j.withColumns(fixed)
