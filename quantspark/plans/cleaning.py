"""Trade cleaning: blocked accounts (C1), VWAP merge of near trades (C2), report."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantspark.config import Params
from quantspark.operators.sessions import interval_us, session_ids

TRADE_COLUMNS = ["id", "timestamp", "account", "direction", "quantity", "price", "pnl",
                 "permutation_id", "holding_time", "threshold"]


def filter_accounts(trades: DataFrame, blocked: Iterable[str] = Params().blocked_accounts) -> DataFrame:
    """Drop trades of blocked accounts (left-anti join; a NULL account is kept).

    The blocked list is configuration (a handful of ids), so the broadcast
    side is bounded by the parameter, not by the data.
    """
    spark = trades.sparkSession
    bl = spark.createDataFrame([(a,) for a in dict.fromkeys(blocked)],
                               T.StructType([T.StructField("account", T.StringType())]))
    return trades.join(F.broadcast(bl), "account", "left_anti").select(*trades.columns)


def vwap_dedup(trades: DataFrame, window: str = Params().dedup_window,
               keys: Sequence[str] = ("account", "permutation_id"),
               num_blocks: int | None = None) -> DataFrame:
    """Merge trades of one key group whose consecutive gaps are <= ``window``.

    price = sum(q*p)/sum(q) (falls back to avg(price) when sum(q)=0),
    quantity and pnl are summed, timestamp/id are the minimum, and
    direction/holding_time/threshold come from the first trade (ts, id).
    The aggregation is partial (map-side), so a hot session is no problem.
    """
    keys = list(keys)
    s = session_ids(trades, keys, ["timestamp", "id"], "timestamp", interval_us(window),
                    num_blocks=num_blocks)
    first = F.struct("timestamp", "id")
    agg = s.groupBy("_session").agg(
        F.min("id").alias("id"),
        F.min("timestamp").alias("timestamp"),
        *[F.first(k).alias(k) for k in keys],
        *[F.min_by(c, first).alias(c) for c in ("direction", "holding_time", "threshold")
          if c not in keys],
        F.sum("quantity").alias("quantity"),
        F.coalesce(F.try_divide(F.sum(F.col("quantity") * F.col("price")),
                                F.when(F.sum("quantity") != 0, F.sum("quantity"))),
                   F.avg("price")).alias("price"),
        F.sum("pnl").alias("pnl"),
        *[F.min_by(c, first).alias(c) for c in TRADE_COLUMNS
          if c not in keys and c not in ("id", "timestamp", "direction", "holding_time",
                                         "threshold", "quantity", "price", "pnl")],
    )
    return agg.select(*[c for c in TRADE_COLUMNS if c in agg.columns])


def clean_trades(raw: DataFrame, params: Params = Params(), num_blocks: int | None = None) -> DataFrame:
    return vwap_dedup(filter_accounts(raw, params.blocked_accounts), params.dedup_window,
                      num_blocks=num_blocks)


def quality_report(raw: DataFrame, filtered: DataFrame, cleaned: DataFrame) -> DataFrame:
    """One row: rows in / blocked / merged / out, nulls per column, time range."""
    r = raw.agg(F.count(F.lit(1)).alias("rows_in"),
                F.min("timestamp").alias("min_timestamp"),
                F.max("timestamp").alias("max_timestamp"))
    f = filtered.agg(F.count(F.lit(1)).alias("rows_after_filter"))
    c = cleaned.agg(F.count(F.lit(1)).alias("rows_out"),
                    *[F.count_if(F.col(x).isNull()).alias(f"null_{x}") for x in cleaned.columns])
    one = F.lit(1)
    rep = (r.withColumn("_k", one).join(f.withColumn("_k", one), "_k")
            .join(c.withColumn("_k", one), "_k").drop("_k"))
    return rep.select(
        "rows_in",
        (F.col("rows_in") - F.col("rows_after_filter")).alias("rows_blocked"),
        (F.col("rows_after_filter") - F.col("rows_out")).alias("rows_merged"),
        "rows_out", "min_timestamp", "max_timestamp",
        *[f"null_{x}" for x in cleaned.columns])
