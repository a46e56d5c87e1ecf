"""Walk-forward folds (I1-I4) as time ranges.

Fold k trains on [s + k*step, s + k*step + train) and tests on the next
``test`` window, where s is the first timestamp and step = test window; a
candidate exists while its test end <= last timestamp + 1 s.  Membership is
integer arithmetic on the timestamp (no range join): a row is in the test
window of exactly one candidate and in the train window of a short run of
candidates, exploded from a sequence.  Candidates with fewer than
``min_train_rows`` train rows or ``min_test_rows`` test rows are dropped
and the rest are numbered 0.. in time order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantspark.config import Params

US_DAY = 86400 * 10**6


def fold_bounds(df: DataFrame, ts: str = "timestamp", params: Params = Params()) -> dict:
    """First/last timestamp (two scalars) and the number of fold candidates."""
    b = df.agg(F.min(F.unix_micros(F.col(ts))).alias("t0"), F.max(F.unix_micros(F.col(ts))).alias("t1")).first()
    tr, te = params.train_days * US_DAY, params.test_days * US_DAY
    if b["t0"] is None:
        return {"t0": 0, "t1": 0, "n": 0, "train": tr, "test": te}
    d = b["t1"] + 10**6 - b["t0"] - tr - te
    n = d // te + 1 if d >= 0 else 0
    return {"t0": b["t0"], "t1": b["t1"], "n": int(n), "train": tr, "test": te}


def _membership(df: DataFrame, ts: str, fb: dict, params: Params, splits=("train", "test")) -> DataFrame:
    rel = F.unix_micros(F.col(ts)) - F.lit(fb["t0"])
    tr, te, n = fb["train"], fb["test"], fb["n"]
    k_test = F.floor((rel - F.lit(tr)) / F.lit(te)).cast("long")
    parts = []
    if "test" in splits:
        test_k = F.when((rel >= tr) & (k_test <= n - 1), F.array(k_test)).otherwise(F.array().cast("array<long>"))
        parts.append(F.transform(test_k, lambda k: F.struct(k.alias("k"), F.lit("test").alias("split"))))
    if "train" in splits:
        k_lo = F.greatest(k_test + 1, F.lit(0).cast("long"))
        k_hi = F.lit(n - 1).cast("long") if params.expanding else F.least(
            F.floor(rel / F.lit(te)).cast("long"), F.lit(n - 1).cast("long"))
        train_k = F.when(k_lo <= k_hi, F.sequence(k_lo, k_hi)).otherwise(F.array().cast("array<long>"))
        parts.append(F.transform(train_k, lambda k: F.struct(k.alias("k"), F.lit("train").alias("split"))))
    arr = parts[0] if len(parts) == 1 else F.concat(*parts)
    return df.withColumn("_m", F.explode(arr)).select("*", "_m.k", "_m.split").drop("_m")


def valid_folds(df: DataFrame, ts: str = "timestamp", params: Params = Params(),
                fb: dict | None = None) -> DataFrame:
    """One row per kept fold: fold number, candidate k, window bounds, sizes."""
    fb = fb or fold_bounds(df, ts, params)
    m = _membership(df.select(ts), ts, fb, params)
    counts = m.groupBy("k").agg(F.count_if(F.col("split") == "train").alias("train_size"),
                                F.count_if(F.col("split") == "test").alias("test_size"))
    kept = counts.filter((F.col("train_size") >= params.min_train_rows)
                         & (F.col("test_size") >= params.min_test_rows))
    # One row per fold candidate: bounded by (time span / test window).
    kept = kept.withColumn("walk_forward_fold", (F.row_number().over(Window.orderBy("k")) - 1).cast("int"))
    start = F.lit(fb["t0"]) + F.col("k") * F.lit(fb["test"])
    train_start = F.lit(fb["t0"]) if params.expanding else start
    return kept.select(
        "walk_forward_fold", "k",
        F.timestamp_micros(train_start).alias("train_start"),
        F.timestamp_micros(start + F.lit(fb["train"])).alias("train_end"),
        F.timestamp_micros(start + F.lit(fb["train"])).alias("test_start"),
        F.timestamp_micros(start + F.lit(fb["train"] + fb["test"])).alias("test_end"),
        "train_size", "test_size")


def fold_table(df: DataFrame, ts: str, pos: str, params: Params, fb: dict) -> list:
    """Kept folds in time order, one row each: k, sizes, trade-time ranges of both windows and the position
    ``p0`` of the first train row, from one aggregation over (timestamp, position)."""
    m = _membership(df.select(ts, pos), ts, fb, params)
    tr = F.col("split") == "train"
    t, u = F.when(tr, F.col(ts)), F.when(~tr, F.col(ts))
    out = m.groupBy("k").agg(
        F.count_if(tr).alias("train_size"), F.count_if(~tr).alias("test_size"), F.min(t).alias("train_start"),
        F.max(t).alias("train_end"), F.min(u).alias("test_start"), F.max(u).alias("test_end"),
        F.min(F.when(tr, F.col(pos))).alias("p0"))
    return (out.filter((F.col("train_size") >= params.min_train_rows) & (F.col("test_size") >= params.min_test_rows))
            .orderBy("k").collect())                       # one row per fold


def cv_block_column(pos, p0: int, n: int, n_splits: int = 3):
    """I4 as one expression for a window of ``n`` consecutive positions from ``p0``: 0 before the first
    validation block, i for the validation block of split i - 1."""
    k = n // (n_splits + 1)
    if k == 0:
        return F.lit(0)
    start = n - n_splits * k
    p = F.col(pos) - F.lit(p0)
    return F.when(p < start, F.lit(0)).otherwise(
        F.least(F.floor((p - start) / F.lit(k)) + 1, F.lit(n_splits))).cast("int")


def assign_folds(df: DataFrame, ts: str = "timestamp", params: Params = Params(),
                 splits=("train", "test")) -> DataFrame:
    """Rows x kept folds they belong to, with ``walk_forward_fold`` and ``split``."""
    fb = fold_bounds(df, ts, params)
    folds = valid_folds(df, ts, params, fb).select("k", "walk_forward_fold")
    m = _membership(df, ts, fb, params, splits)
    return m.join(folds, "k").drop("k")   # one row per candidate window: the optimizer knows its size


def check_folds(assigned: DataFrame, ts: str = "timestamp", id_col: str = "trade_id") -> DataFrame:
    """Per fold max(train ts), min(test ts), shared ids; ``leak`` flags a violation."""
    agg = assigned.groupBy("walk_forward_fold").agg(
        F.max(F.when(F.col("split") == "train", F.col(ts))).alias("max_train_ts"),
        F.min(F.when(F.col("split") == "test", F.col(ts))).alias("min_test_ts"))
    tr = assigned.filter(F.col("split") == "train").select("walk_forward_fold", id_col)
    te = assigned.filter(F.col("split") == "test").select("walk_forward_fold", id_col)
    shared = tr.join(te, ["walk_forward_fold", id_col], "left_semi").groupBy("walk_forward_fold").agg(
        F.count(F.lit(1)).alias("shared_ids"))
    out = agg.join(shared, "walk_forward_fold", "left").fillna(0, ["shared_ids"])
    return out.withColumn("leak", (F.col("max_train_ts") >= F.col("min_test_ts")) | (F.col("shared_ids") > 0))


def time_series_splits(train: DataFrame, n_splits: int = 3, order=("timestamp", "trade_id"),
                       fold_col: str = "walk_forward_fold") -> DataFrame:
    """I4: expanding validation splits inside each fold's train rows.

    For n train rows, k = n // (n_splits + 1); validation split i covers
    positions [n - (n_splits - i) * k, n - (n_splits - i - 1) * k) and trains
    on all earlier positions.  Output: the rows x splits they belong to,
    with ``cv_split`` and ``cv_role`` ('fit' / 'val').
    """
    from quantspark.operators.ordered import POS, with_position
    pos = with_position(train, [fold_col, *order])
    first = pos.groupBy(fold_col).agg(F.min(POS).alias("_p0"), F.count(F.lit(1)).alias("_n"))
    x = pos.join(F.broadcast(first), fold_col)  # one row per fold
    p = F.col(POS) - F.col("_p0")
    k = F.floor(F.col("_n") / F.lit(n_splits + 1))
    splits = []
    for i in range(n_splits):
        v0 = F.col("_n") - (n_splits - i) * k
        v1 = v0 + k
        role = F.when(p < v0, F.lit("fit")).when(p < v1, F.lit("val"))
        splits.append(F.struct(F.lit(i).alias("cv_split"), role.alias("cv_role")))
    x = x.withColumn("_s", F.explode(F.filter(F.array(*splits), lambda s: s["cv_role"].isNotNull())))
    return x.select("*", "_s.cv_split", "_s.cv_role").drop("_s", "_p0", "_n", POS)


def fold_windows(assigned: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Per fold: sizes and trade-time ranges of the train and test rows (Q10: trade time)."""
    tr = F.col("split") == "train"
    return assigned.groupBy("walk_forward_fold").agg(
        F.count_if(tr).alias("train_size"), F.count_if(~tr).alias("test_size"),
        F.min(F.when(tr, F.col(ts))).alias("train_start"), F.max(F.when(tr, F.col(ts))).alias("train_end"),
        F.min(F.when(~tr, F.col(ts))).alias("test_start"), F.max(F.when(~tr, F.col(ts))).alias("test_end"))


def cv_blocks(train: DataFrame, n_splits: int = 3, order=("timestamp", "trade_id"),
              fold_col: str = "walk_forward_fold") -> DataFrame:
    """I4 as one column: ``cv_block`` 0 = rows before the first validation block,
    i = validation block of split i-1.  Split i fits on blocks <= i and
    validates on block i+1 (no row duplication)."""
    from quantspark.operators.ordered import POS, with_position
    pos = with_position(train, [fold_col, *order])
    first = pos.groupBy(fold_col).agg(F.min(POS).alias("_p0"), F.count(F.lit(1)).alias("_n"))
    x = pos.join(F.broadcast(first), fold_col)  # one row per fold
    p = F.col(POS) - F.col("_p0")
    k = F.floor(F.col("_n") / F.lit(n_splits + 1))
    start = F.col("_n") - n_splits * k
    blk = F.when((k == 0) | (p < start), F.lit(0)).otherwise(
        F.least(F.floor((p - start) / k) + 1, F.lit(n_splits)))
    return x.withColumn("cv_block", blk.cast("int")).drop("_p0", "_n", POS)
