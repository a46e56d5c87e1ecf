"""Adaptors: the driver's Parquet tables -> the data model of this library.

Each adaptor is a plain projection / aggregation of the given tables, so all
work grows with them.  ``FIXTURE_SQL`` holds the same adaptors as DuckDB SQL
(common-table expressions) for the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.config import MACRO_SERIES

# Fixed values of the fixtures: order priorities, in sorted order, mapped to series ids.
PRIORITY_SERIES = {
    "1-URGENT": "CPIAUCSL",
    "2-HIGH": "DGS10",
    "3-MEDIUM": "DGS2",
    "4-NOT SPECIFIED": "FEDFUNDS",
    "5-LOW": "UNRATE",
}
EVENTS_MACRO_SHIFT_DAYS = 8200
# A few real fixture accounts are blocked besides the configured ones (check C1).
FIXTURE_BLOCKED = ("ACC_7", "ACC_42", "ACC_101")

assert tuple(PRIORITY_SERIES.values()) == MACRO_SERIES


def _tbl(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trades_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _tbl(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("ACC_"), F.col("user_id").cast("string")).alias("account"),
        F.when(F.col("event_id") % 2 == 0, "BUY").otherwise("SELL").alias("direction"),
        (F.lit(1.0) + (F.col("event_id") % 10)).cast("double").alias("quantity"),
        (F.lit(100.0) + F.col("value")).alias("price"),
        (F.col("value") - 50.0).alias("pnl"),
        F.concat(F.lit("P_"), F.col("event_type")).alias("permutation_id"),
        F.get_json_object("props", "$.k").cast("double").alias("holding_time"),
        ((F.col("event_id") % 5) / 10.0).cast("double").alias("threshold"),
    )


def trades_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _tbl(spark, sf_dir, "lineitem")
    # An order has at most a few lines: this window is partitioned by a small group.
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    return li.select(
        (F.col("l_orderkey") * 1000 + F.row_number().over(w)).alias("id"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("ACC_"), (F.col("l_orderkey") % 100).cast("string")).alias("account"),
        F.when(F.col("l_linenumber") % 2 == 0, "BUY").otherwise("SELL").alias("direction"),
        F.col("l_quantity").alias("quantity"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
        (F.col("l_extendedprice") * (F.col("l_discount") - 0.05)).alias("pnl"),
        F.concat(F.lit("P_"), F.col("l_returnflag"), F.col("l_linestatus")).alias("permutation_id"),
        F.col("l_linenumber").cast("double").alias("holding_time"),
        F.col("l_tax").alias("threshold"),
    )


def macro_from_orders(spark: SparkSession, sf_dir: str, shift_days: int = EVENTS_MACRO_SHIFT_DAYS,
                      daily: bool = False) -> DataFrame:
    """Monthly (or daily) series: average order price per priority and period."""
    o = _tbl(spark, sf_dir, "orders")
    mapping = F.create_map(*[F.lit(x) for kv in PRIORITY_SERIES.items() for x in kv])
    day = F.date_add(F.to_date("o_orderdate"), shift_days)
    period = day if daily else F.trunc(day, "month")
    agg = (o.select(mapping[F.col("o_orderpriority")].alias("series_id"),
                    period.alias("date"), "o_totalprice")
           .groupBy("series_id", "date")
           .agg(F.avg("o_totalprice").alias("value")))
    from quantspark.plans.macro import with_release_date
    return with_release_date(agg).select(
        "series_id", "date", "value", "release_date",
        F.lit("daily" if daily else "monthly").alias("frequency"),
        F.lit("ORDERS").alias("source"),
    )


# ---------------------------------------------------------------------------
# DuckDB versions of the adaptors (common-table expressions).
# ---------------------------------------------------------------------------

TRADES_EVENTS_SQL = """
trades AS (
  SELECT event_id AS id,
         CAST(ts AS TIMESTAMP) AS "timestamp",
         'ACC_' || CAST(user_id AS VARCHAR) AS account,
         CASE WHEN event_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS direction,
         CAST(1 + event_id % 10 AS DOUBLE) AS quantity,
         100.0::DOUBLE + value AS price,
         value - 50.0::DOUBLE AS pnl,
         'P_' || event_type AS permutation_id,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS holding_time,
         CAST(event_id % 5 AS DOUBLE) / 10.0::DOUBLE AS threshold
  FROM events
)"""

TRADES_LINEITEM_SQL = """
trades AS (
  SELECT l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS id,
         CAST(l_shipdate AS TIMESTAMP) AS "timestamp",
         'ACC_' || CAST(l_orderkey % 100 AS VARCHAR) AS account,
         CASE WHEN l_linenumber % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS direction,
         l_quantity AS quantity,
         CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS price,
         l_extendedprice * (l_discount - 0.05::DOUBLE) AS pnl,
         'P_' || l_returnflag || l_linestatus AS permutation_id,
         CAST(l_linenumber AS DOUBLE) AS holding_time,
         l_tax AS threshold
  FROM lineitem
)"""


def macro_sql(shift_days: int = EVENTS_MACRO_SHIFT_DAYS, daily: bool = False) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY_SERIES.items())
    day = f"(CAST(o_orderdate AS DATE) + {int(shift_days)})"
    period = day if daily else f"CAST(date_trunc('month', {day}) AS DATE)"
    freq = "daily" if daily else "monthly"
    return f"""
macro_series AS (
  SELECT series_id, date, value,
         CAST(date + 30 AS TIMESTAMP) + INTERVAL '8 hours 30 minutes' AS release_date,
         '{freq}' AS frequency, 'ORDERS' AS source
  FROM (SELECT CASE o_orderpriority {cases} END AS series_id,
               {period} AS date,
               avg(o_totalprice) AS value
        FROM orders GROUP BY 1, 2) g
)"""


# Walk-forward windows that fit the 30-day events table (train 14 d, test 3 d).
FIXTURE_FOLD_DAYS = (14, 3)
FIXTURE_EXPERIMENT = "exp_fixture"


def fixture_params():
    from quantspark.config import Params
    return Params(train_days=FIXTURE_FOLD_DAYS[0], test_days=FIXTURE_FOLD_DAYS[1])


def predictions_from_trades(trades: DataFrame, block_rows: int = 1 << 16) -> DataFrame:
    """Deterministic predictions: the previous pnl of the same (account,
    permutation) group (0 for the first), for the test rows of each fold."""
    from quantspark.operators.ordered import halo_window
    from quantspark.plans.folds import assign_folds
    p = halo_window(trades.select("id", "timestamp", "account", "permutation_id", "pnl"), 1,
                    lambda w: {"predicted_pnl": F.coalesce(F.lag("pnl", 1).over(w), F.lit(0.0))},
                    order=["timestamp", "id"], group=["account", "permutation_id"], block_rows=block_rows)
    p = assign_folds(p, "timestamp", fixture_params(), splits=("test",))
    return p.select(F.col("id").alias("trade_id"), "timestamp", "permutation_id", "predicted_pnl",
                    F.col("pnl").alias("actual_pnl"), "walk_forward_fold",
                    F.lit(FIXTURE_EXPERIMENT).alias("experiment_id"))


def folds_sql(src: str = "trades", train_days: int = FIXTURE_FOLD_DAYS[0], test_days: int = FIXTURE_FOLD_DAYS[1],
              min_train: int = 10, min_test: int = 1) -> str:
    """CTEs fold_cand (k, s) / fold_member (row x k x split) / folds (kept, numbered)."""
    tr, te = train_days * 86400 * 10**6, test_days * 86400 * 10**6
    return f"""
fold_b AS (SELECT min(epoch_us("timestamp")) AS t0, max(epoch_us("timestamp")) AS t1 FROM {src}),
fold_n AS (SELECT t0, CASE WHEN t1 + 1000000 - t0 - {tr} - {te} >= 0
                           THEN CAST(floor((t1 + 1000000 - t0 - {tr} - {te}) / {te}) AS BIGINT) + 1
                           ELSE 0 END AS n FROM fold_b),
fold_cand AS (SELECT k, t0 + k * {te} AS s FROM fold_n, range(0, (SELECT n FROM fold_n)) r(k)),
fold_member AS (
  SELECT x.*, c.k, CASE WHEN epoch_us(x."timestamp") >= c.s + {tr} THEN 'test' ELSE 'train' END AS split
  FROM {src} x JOIN fold_cand c
    ON epoch_us(x."timestamp") >= c.s AND epoch_us(x."timestamp") < c.s + {tr} + {te}),
fold_counts AS (SELECT k, count_if(split = 'train') AS train_size, count_if(split = 'test') AS test_size
                FROM fold_member GROUP BY k),
folds AS (
  SELECT CAST(row_number() OVER (ORDER BY f.k) - 1 AS INTEGER) AS walk_forward_fold, f.k,
         make_timestamp(c.s) AS train_start, make_timestamp(c.s + {tr}) AS train_end,
         make_timestamp(c.s + {tr}) AS test_start, make_timestamp(c.s + {tr} + {te}) AS test_end,
         f.train_size, f.test_size
  FROM fold_counts f JOIN fold_cand c USING (k)
  WHERE f.train_size >= {min_train} AND f.test_size >= {min_test})"""


PREDICTIONS_SQL = """
pred_src AS (
  SELECT *, coalesce(lag(pnl) OVER (PARTITION BY account, permutation_id ORDER BY "timestamp", id), 0.0)
              AS predicted_pnl
  FROM trades),""" + folds_sql("pred_src").rstrip() + """,
predictions AS (
  SELECT m.id AS trade_id, m."timestamp", m.permutation_id, m.predicted_pnl, m.pnl AS actual_pnl,
         f.walk_forward_fold, 'exp_fixture' AS experiment_id
  FROM fold_member m JOIN folds f USING (k)
  WHERE m.split = 'test')"""
