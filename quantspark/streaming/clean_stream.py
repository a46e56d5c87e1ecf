"""Trade cleaning on a stream (blocked accounts + VWAP merge of near trades).

Structured Streaming version of C1 + C2: a stream-static left-anti join
against the blocked accounts, then ``session_window`` sessions per
(account, permutation_id) with a watermark; sessions are emitted in append
mode once the watermark passes their end.  Same aggregates as the batch job.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantspark.config import Params
from quantspark.plans.cleaning import TRADE_COLUMNS


def clean_stream(trades: DataFrame, blocked: Iterable[str] = Params().blocked_accounts,
                 gap: str = Params().dedup_window, watermark: str = "1 minute") -> DataFrame:
    spark = trades.sparkSession
    bl = spark.createDataFrame([(a,) for a in dict.fromkeys(blocked)],
                               T.StructType([T.StructField("account", T.StringType())]))
    kept = trades.join(F.broadcast(bl), "account", "left_anti")
    first = F.struct("timestamp", "id")
    agg = (kept.withWatermark("timestamp", watermark)
               .groupBy("account", "permutation_id", F.session_window("timestamp", gap).alias("_s"))
               .agg(F.min("id").alias("id"), F.min("timestamp").alias("timestamp"),
                    F.min_by("direction", first).alias("direction"),
                    F.sum("quantity").alias("quantity"),
                    F.coalesce(F.try_divide(F.sum(F.col("quantity") * F.col("price")),
                                            F.when(F.sum("quantity") != 0, F.sum("quantity"))),
                               F.avg("price")).alias("price"),
                    F.sum("pnl").alias("pnl"),
                    F.min_by("holding_time", first).alias("holding_time"),
                    F.min_by("threshold", first).alias("threshold")))
    return agg.select(*TRADE_COLUMNS)


def start_clean_stream(trades: DataFrame, sink_path: str, checkpoint: str, **kw):
    """Append cleaned trades to a Parquet sink (exactly-once with the checkpoint)."""
    return (clean_stream(trades, **kw).writeStream.outputMode("append").format("parquet")
            .option("path", sink_path).option("checkpointLocation", checkpoint).start())
