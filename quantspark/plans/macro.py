"""Macro series ingestion transforms (B1-B7) and per-series percent change (F1)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.operators.ordered import halo_window

SERIES_COLUMNS = ["series_id", "date", "value", "release_date", "frequency", "source"]
EVENT_COLUMNS = ["timestamp_utc", "event_name", "country", "importance", "actual", "forecast",
                 "previous", "surprise", "source", "scraper_version", "raw_event_json"]


def filter_dates(df: DataFrame, start: str | None, end: str | None, col: str = "date") -> DataFrame:
    """``start <= date <= end`` (both inclusive); pushed down to the Parquet scan."""
    c = F.col(col)
    if start is not None:
        df = df.filter(c >= F.to_date(F.lit(start)))
    if end is not None:
        df = df.filter(c <= F.to_date(F.lit(end)))
    return df


def drop_null_values(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["value"])


def with_release_date(df: DataFrame, lag_days: int = 30, at: str = "08:30") -> DataFrame:
    """release_date = observation date + ``lag_days`` at ``at`` UTC."""
    h, m = (int(p) for p in at.split(":"))
    return df.withColumn(
        "release_date",
        F.date_add("date", lag_days).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(h), F.lit(m)))


def normalise(df: DataFrame, series_id: str | None = None, source: str = "FRED",
              frequency: str = "monthly") -> DataFrame:
    """Literal columns and the 6-column projection of ``macro_series``."""
    if series_id is not None:
        df = df.withColumn("series_id", F.lit(series_id))
    df = df.withColumns({"source": F.lit(source), "frequency": F.lit(frequency)})
    if "release_date" not in df.columns:
        df = with_release_date(df)
    return df.select(*SERIES_COLUMNS)


def union_series(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    if not frames:
        raise ValueError("no series to union")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def sort_series(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Order by (series_id, date) for writing: range partitions, sorted inside."""
    n = num_partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return df.repartitionByRange(int(n), "series_id", "date").sortWithinPartitions("series_id", "date")


def derive_events(series: DataFrame, block_rows: int = 1 << 16) -> DataFrame:
    """macro_series -> macro_events: previous = prior actual of the same series by date."""
    ev = series.select(
        F.col("release_date").alias("timestamp_utc"), F.col("series_id").alias("event_name"),
        F.col("value").alias("actual"), "date", "source")
    ev = halo_window(ev, 1, lambda w: {"previous": F.lag("actual", 1).over(w)},
                     order=["date"], group=["event_name"], block_rows=block_rows)
    return ev.select(
        "timestamp_utc", "event_name", F.lit("US").alias("country"), F.lit("high").alias("importance"),
        "actual", F.lit(None).cast("double").alias("forecast"), "previous",
        F.lit(None).cast("double").alias("surprise"), "source", F.lit("2.0").alias("scraper_version"),
        F.lit(None).cast("string").alias("raw_event_json"))


def pct_change(series: DataFrame, block_rows: int = 1 << 16) -> DataFrame:
    """x = value / previous value of the series - 1 in release order; first row -> 0.0.

    A previous value of 0 gives 0.0 (a stated deviation: +-inf would poison
    every later stream statistic).
    """
    return halo_window(
        series, 1,
        lambda w: {"pct_change": F.coalesce(
            F.try_divide(F.col("value"), F.when(F.lag("value", 1).over(w) != 0,
                                                F.lag("value", 1).over(w))) - 1.0,
            F.lit(0.0))},
        order=[F.col("release_date").asc_nulls_last(), "date"], group=["series_id"],
        block_rows=block_rows)
