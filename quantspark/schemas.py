"""Table schemas (the seven tables of the data model) as StructTypes."""

from pyspark.sql import types as T

TRADES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("account", T.StringType()),
    T.StructField("direction", T.StringType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("pnl", T.DoubleType()),
    T.StructField("permutation_id", T.StringType()),
    T.StructField("holding_time", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
])

MACRO_SERIES = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("release_date", T.TimestampType()),
    T.StructField("frequency", T.StringType()),
    T.StructField("source", T.StringType()),
])

MACRO_EVENTS = T.StructType([
    T.StructField("timestamp_utc", T.TimestampType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("importance", T.StringType()),
    T.StructField("actual", T.DoubleType()),
    T.StructField("forecast", T.DoubleType()),
    T.StructField("previous", T.DoubleType()),
    T.StructField("surprise", T.DoubleType()),
    T.StructField("source", T.StringType()),
    T.StructField("scraper_version", T.StringType()),
    T.StructField("raw_event_json", T.StringType()),
])

PREDICTIONS = T.StructType([
    T.StructField("trade_id", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("permutation_id", T.StringType()),
    T.StructField("predicted_pnl", T.DoubleType()),
    T.StructField("actual_pnl", T.DoubleType()),
    T.StructField("walk_forward_fold", T.IntegerType()),
    T.StructField("experiment_id", T.StringType()),
])

WALK_FORWARD_RESULTS = T.StructType([
    T.StructField("fold", T.IntegerType()),
    T.StructField("best_model", T.StringType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("r2", T.DoubleType()),
    T.StructField("train_size", T.LongType()),
    T.StructField("test_size", T.LongType()),
    T.StructField("train_start", T.TimestampType()),
    T.StructField("train_end", T.TimestampType()),
    T.StructField("test_start", T.TimestampType()),
    T.StructField("test_end", T.TimestampType()),
    T.StructField("metrics", T.StringType()),
    T.StructField("experiment_id", T.StringType()),
])

EXPERIMENTS = T.StructType([
    T.StructField("experiment_id", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("parameters", T.MapType(T.StringType(), T.StringType())),
    T.StructField("dataset_version", T.StringType()),
    T.StructField("feature_version", T.StringType()),
    T.StructField("provider_version", T.StringType()),
    T.StructField("feature_count", T.IntegerType()),
    T.StructField("series_used", T.ArrayType(T.StringType())),
    T.StructField("git_commit", T.StringType()),
    T.StructField("random_seed", T.IntegerType()),
    T.StructField("created_at", T.TimestampType()),
])

# Feature-store column order (fixed: equals the reference schema order).
FEATURE_COLUMNS = [
    "trade_id", "feature_version", "pipeline_version", "feature_timestamp",
    "hour_of_day", "day_of_week", "week_of_month", "month", "quarter",
    "market_session", "minutes_after_open", "minutes_before_close",
    "rolling_pnl_5", "rolling_pnl_20", "rolling_win_rate", "rolling_avg_quantity",
    "rolling_trade_frequency", "rolling_volatility", "rolling_drawdown",
    "days_since_release", "days_until_next_release", "release_frequency",
    "rolling_mean", "rolling_std", "rolling_min", "rolling_max", "rolling_median",
    "rolling_percent_change", "rolling_zscore", "macro_rolling_volatility",
    "macro_rolling_variance", "macro_rolling_percentile", "macro_ewma",
    "rolling_skewness", "rolling_kurtosis", "expanding_mean", "expanding_std",
    "macro_momentum", "macro_acceleration", "macro_regime",
    "yield_curve_spread", "inflation_momentum",
    "lag_1", "lag_3", "lag_6", "lag_12",
    "holding_time", "threshold", "risk_parameters", "permutation_id",
    "pnl",
]

_FEATURE_TYPES = {
    "trade_id": T.LongType(), "feature_timestamp": T.TimestampType(),
    **{c: T.StringType() for c in ("feature_version", "pipeline_version", "market_session", "risk_parameters",
                                   "permutation_id")},
    **{c: T.IntegerType() for c in ("hour_of_day", "day_of_week", "week_of_month", "month", "quarter")},
}
FEATURE_STORE = T.StructType([T.StructField(c, _FEATURE_TYPES.get(c, T.DoubleType())) for c in FEATURE_COLUMNS])

TABLES = {
    "trades": TRADES,
    "feature_store": FEATURE_STORE,
    "macro_series": MACRO_SERIES,
    "macro_events": MACRO_EVENTS,
    "predictions": PREDICTIONS,
    "walk_forward_results": WALK_FORWARD_RESULTS,
    "experiments": EXPERIMENTS,
}
