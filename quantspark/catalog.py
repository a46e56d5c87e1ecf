"""Registered queries: Spark builders and their DuckDB oracle SQL.

Every query reads the driver's tables (through the adaptors of
``quantspark.sources.fixtures``) and runs over the whole tables.  Keys name
the operator ids of the survey inventory.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.config import DEFAULT_BLOCKED_ACCOUNTS, Params
from quantspark.plans import cleaning, features, macro
from quantspark.session import prepare_session
from quantspark.sources import fixtures as fx

# Fixed run stamp of the registered feature-store query (feature_timestamp
# is the build time in production; a constant keeps the check deterministic).
RUN_STAMP = dt.datetime(2024, 6, 1, 0, 0, 0)
BLOCKED = DEFAULT_BLOCKED_ACCOUNTS + fx.FIXTURE_BLOCKED
P = Params()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def _trades(spark, sf):
    prepare_session(spark)
    return fx.trades_from_events(spark, sf)


def _macro(spark, sf):
    return fx.macro_from_orders(spark, sf)


# ---------------------------------------------------------------------------
# A: sources
# ---------------------------------------------------------------------------

register("a2_trades_from_events", _with(fx.TRADES_EVENTS_SQL) + "SELECT * FROM trades")(
    lambda spark, sf: _trades(spark, sf))

register("a2_trades_from_lineitem", _with(fx.TRADES_LINEITEM_SQL) + "SELECT * FROM trades")(
    lambda spark, sf: (prepare_session(spark), fx.trades_from_lineitem(spark, sf))[1])

@register("a3_parameterised_sql", _with(fx.TRADES_EVENTS_SQL) + """
SELECT permutation_id, count(*) AS n, sum(pnl) AS pnl, min("timestamp") AS first_trade
FROM trades WHERE permutation_id = 'P_click' GROUP BY permutation_id""")
def _a3(spark, sf):
    """A3: a parameterised SELECT over a temp view (named parameter :perm)."""
    from quantspark.sources.tables import sql
    return sql(spark, "SELECT permutation_id, count(*) AS n, sum(pnl) AS pnl, min(`timestamp`) AS first_trade "
                      "FROM trades WHERE permutation_id = :perm GROUP BY permutation_id",
               {"trades": _trades(spark, sf)}, perm="P_click")


# ---------------------------------------------------------------------------
# B: macro ingestion
# ---------------------------------------------------------------------------

register("b3_macro_series", _with(fx.macro_sql()) + "SELECT * FROM macro_series")(
    lambda spark, sf: (prepare_session(spark), _macro(spark, sf))[1])


@register("b1_b2_filter_series", _with(fx.macro_sql(daily=True)) + """
SELECT * FROM macro_series
WHERE value IS NOT NULL AND date BETWEEN DATE '2018-01-01' AND DATE '2022-12-31'""")
def _b1(spark, sf):
    prepare_session(spark)
    s = fx.macro_from_orders(spark, sf, daily=True)
    return macro.drop_null_values(macro.filter_dates(s, "2018-01-01", "2022-12-31"))


@register("b5_b6_union_series", _with(fx.macro_sql(daily=True)) + "SELECT * FROM macro_series")
def _b5(spark, sf):
    """B5 + B6: one frame per series, stacked by name, ordered (series_id, date) for writing."""
    prepare_session(spark)
    s = fx.macro_from_orders(spark, sf, daily=True)
    per_series = [s.filter(F.col("series_id") == sid) for sid in fx.PRIORITY_SERIES.values()]
    return macro.sort_series(macro.union_series(per_series))


@register("b7_derive_events", _with(fx.macro_sql()) + """
SELECT release_date AS timestamp_utc, series_id AS event_name, 'US' AS country, 'high' AS importance,
       value AS actual, CAST(NULL AS DOUBLE) AS forecast,
       lag(value) OVER (PARTITION BY series_id ORDER BY date) AS previous,
       CAST(NULL AS DOUBLE) AS surprise, source, '2.0' AS scraper_version,
       CAST(NULL AS VARCHAR) AS raw_event_json
FROM macro_series""")
def _b7(spark, sf):
    prepare_session(spark)
    return macro.derive_events(_macro(spark, sf))


@register("f1_pct_change", _with(fx.macro_sql(daily=True)) + """
SELECT series_id, date, value, release_date, frequency, source,
       coalesce(value / NULLIF(lag(value) OVER (PARTITION BY series_id ORDER BY release_date NULLS LAST, date), 0)
                - 1.0, 0.0) AS pct_change
FROM macro_series""")
def _f1(spark, sf):
    prepare_session(spark)
    return macro.pct_change(fx.macro_from_orders(spark, sf, daily=True))


# ---------------------------------------------------------------------------
# C: cleaning
# ---------------------------------------------------------------------------

_blocked_sql = ", ".join(f"'{a}'" for a in BLOCKED)

register("c1_filter_accounts", _with(fx.TRADES_EVENTS_SQL) + f"""
SELECT * FROM trades WHERE account IS NULL OR account NOT IN ({_blocked_sql})""")(
    lambda spark, sf: cleaning.filter_accounts(_trades(spark, sf), BLOCKED))


def _vwap_sql(gap_us: int) -> str:
    return _with(fx.TRADES_EVENTS_SQL, f"""
flagged AS (
  SELECT *, CASE WHEN lag("timestamp") OVER w IS NULL
                   OR epoch_us("timestamp") - epoch_us(lag("timestamp") OVER w) > {gap_us}
                 THEN 1 ELSE 0 END AS new_session
  FROM trades
  WINDOW w AS (PARTITION BY account, permutation_id ORDER BY "timestamp", id))""", """
sessions AS (
  SELECT *, sum(new_session) OVER (PARTITION BY account, permutation_id ORDER BY "timestamp", id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sess
  FROM flagged)""") + """
SELECT min(id) AS id, min("timestamp") AS "timestamp", account,
       arg_min(direction, ("timestamp", id)) AS direction,
       sum(quantity) AS quantity,
       coalesce(sum(quantity * price) / NULLIF(sum(quantity), 0), avg(price)) AS price,
       sum(pnl) AS pnl, permutation_id,
       arg_min(holding_time, ("timestamp", id)) AS holding_time,
       arg_min(threshold, ("timestamp", id)) AS threshold
FROM sessions GROUP BY account, permutation_id, sess"""


register("c2_vwap_dedup_500ms", _vwap_sql(500_000))(
    lambda spark, sf: cleaning.vwap_dedup(_trades(spark, sf), "500 milliseconds"))
register("c2_vwap_dedup_1h", _vwap_sql(3_600_000_000))(
    lambda spark, sf: cleaning.vwap_dedup(_trades(spark, sf), "1 hour"))


_C3_SQL = _with(fx.TRADES_EVENTS_SQL, f"""
filt AS (SELECT * FROM trades WHERE account IS NULL OR account NOT IN ({_blocked_sql}))""", """
flagged AS (
  SELECT *, CASE WHEN lag("timestamp") OVER w IS NULL
                   OR epoch_us("timestamp") - epoch_us(lag("timestamp") OVER w) > 3600000000
                 THEN 1 ELSE 0 END AS new_session
  FROM filt
  WINDOW w AS (PARTITION BY account, permutation_id ORDER BY "timestamp", id))""", """
sessions AS (
  SELECT *, sum(new_session) OVER (PARTITION BY account, permutation_id ORDER BY "timestamp", id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sess
  FROM flagged)""", """
cleaned AS (
  SELECT min(id) AS id, min("timestamp") AS "timestamp", account,
         arg_min(direction, ("timestamp", id)) AS direction, sum(quantity) AS quantity,
         coalesce(sum(quantity * price) / NULLIF(sum(quantity), 0), avg(price)) AS price,
         sum(pnl) AS pnl, permutation_id,
         arg_min(holding_time, ("timestamp", id)) AS holding_time,
         arg_min(threshold, ("timestamp", id)) AS threshold
  FROM sessions GROUP BY account, permutation_id, sess)""") + """
SELECT (SELECT count(*) FROM trades) AS rows_in,
       (SELECT count(*) FROM trades) - (SELECT count(*) FROM filt) AS rows_blocked,
       (SELECT count(*) FROM filt) - (SELECT count(*) FROM cleaned) AS rows_merged,
       (SELECT count(*) FROM cleaned) AS rows_out,
       (SELECT min("timestamp") FROM trades) AS min_timestamp,
       (SELECT max("timestamp") FROM trades) AS max_timestamp,
       count_if(id IS NULL) AS null_id, count_if("timestamp" IS NULL) AS null_timestamp,
       count_if(account IS NULL) AS null_account, count_if(direction IS NULL) AS null_direction,
       count_if(quantity IS NULL) AS null_quantity, count_if(price IS NULL) AS null_price,
       count_if(pnl IS NULL) AS null_pnl, count_if(permutation_id IS NULL) AS null_permutation_id,
       count_if(holding_time IS NULL) AS null_holding_time, count_if(threshold IS NULL) AS null_threshold
FROM cleaned"""


def _c3(spark, sf):
    raw = _trades(spark, sf)
    filt = cleaning.filter_accounts(raw, BLOCKED)
    return cleaning.quality_report(raw, filt, cleaning.vwap_dedup(filt, "1 hour"))


register("c3_quality_report", _C3_SQL)(_c3)

# ---------------------------------------------------------------------------
# D, E: time and rolling trade features
# ---------------------------------------------------------------------------


def _session_sql(ts: str = '"timestamp"') -> tuple[str, str, str]:
    m = f"(hour({ts}) * 60 + minute({ts}))"
    name, after, before = [], [], []
    for s, o, c in P.session_minutes():
        cond = f"{m} >= {o} AND {m} < {c}"
        name.append(f"WHEN {cond} THEN '{s}'")
        after.append(f"WHEN {cond} THEN CAST({m} - {o} AS DOUBLE)")
        before.append(f"WHEN {cond} THEN CAST({c} - {m} AS DOUBLE)")
    return ("CASE " + " ".join(name) + " ELSE 'off_hours' END",
            "CASE " + " ".join(after) + " END",
            "CASE " + " ".join(before) + " END")


def time_sql(ts: str = '"timestamp"') -> str:
    s, a, b = _session_sql(ts)
    return f"""
       CAST(hour({ts}) AS INTEGER) AS hour_of_day,
       CAST(isodow({ts}) - 1 AS INTEGER) AS day_of_week,
       CAST(ceil((day({ts}) + isodow(CAST(date_trunc('month', {ts}) AS DATE)) - 1) / 7.0) AS INTEGER)
         AS week_of_month,
       CAST(month({ts}) AS INTEGER) AS month,
       CAST(quarter({ts}) AS INTEGER) AS quarter,
       {s} AS market_session, {a} AS minutes_after_open, {b} AS minutes_before_close"""


register("d_time_features", _with(fx.TRADES_EVENTS_SQL) + f"""
SELECT id AS trade_id, {time_sql()} FROM trades""")(
    lambda spark, sf: features.add_time(_trades(spark, sf)).select(
        F.col("id").alias("trade_id"), "hour_of_day", "day_of_week", "week_of_month", "month",
        "quarter", "market_session", "minutes_after_open", "minutes_before_close"))


def rolling_sql(src: str = "trades") -> str:
    W = 'PARTITION BY account, permutation_id ORDER BY "timestamp", id'
    s, L = P.rolling_short, P.rolling_long
    valid = "account IS NOT NULL AND permutation_id IS NOT NULL"
    return f"""
rolled AS (
  SELECT *,
    avg(pnl) OVER ({W} ROWS BETWEEN {s} PRECEDING AND 1 PRECEDING) AS r_pnl_s,
    avg(pnl) OVER ({W} ROWS BETWEEN {L} PRECEDING AND 1 PRECEDING) AS r_pnl_l,
    coalesce(sum(CASE WHEN pnl > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
               OVER ({W} ROWS BETWEEN {L} PRECEDING AND 1 PRECEDING), 0.0::DOUBLE)
      / count(*) OVER ({W} ROWS BETWEEN {L - 1} PRECEDING AND CURRENT ROW) AS r_win,
    avg(quantity) OVER ({W} ROWS BETWEEN {L} PRECEDING AND 1 PRECEDING) AS r_qty,
    CAST(count(pnl) OVER ({W} ROWS BETWEEN {L} PRECEDING AND 1 PRECEDING) AS DOUBLE) AS r_freq,
    stddev_samp(pnl) OVER ({W} ROWS BETWEEN {L} PRECEDING AND 1 PRECEDING) AS r_vol,
    list_filter(list(pnl) OVER ({W} ROWS BETWEEN {L} PRECEDING AND 1 PRECEDING),
                lambda v: v IS NOT NULL) AS r_list
  FROM {src}),
rolled_cum AS (
  SELECT *, list_transform(range(1, len(r_list) + 1), lambda k: list_sum(r_list[1:k])) AS r_cum
  FROM rolled),
rolling AS (
  SELECT *,
    CASE WHEN {valid} THEN r_pnl_s END AS rolling_pnl_5,
    CASE WHEN {valid} THEN r_pnl_l END AS rolling_pnl_20,
    CASE WHEN {valid} THEN r_win END AS rolling_win_rate,
    CASE WHEN {valid} THEN r_qty END AS rolling_avg_quantity,
    CASE WHEN {valid} THEN r_freq END AS rolling_trade_frequency,
    CASE WHEN {valid} THEN r_vol END AS rolling_volatility,
    CASE WHEN {valid} AND len(r_cum) > 0 THEN
      list_max(list_transform(range(1, len(r_cum) + 1), lambda j: list_max(r_cum[1:j]) - r_cum[j]))
    END AS rolling_drawdown
  FROM rolled_cum)"""


register("e_rolling_features", _with(fx.TRADES_EVENTS_SQL, rolling_sql()) + """
SELECT id AS trade_id, account, permutation_id, rolling_pnl_5, rolling_pnl_20, rolling_win_rate,
       rolling_avg_quantity, rolling_trade_frequency, rolling_volatility, rolling_drawdown
FROM rolling""")(
    lambda spark, sf: features.add_rolling(_trades(spark, sf)).select(
        F.col("id").alias("trade_id"), "account", "permutation_id", *features.ROLLING_COLUMNS))

register("e_rolling_features_lineitem", _with(fx.TRADES_LINEITEM_SQL, rolling_sql()) + """
SELECT id AS trade_id, account, permutation_id, rolling_pnl_5, rolling_pnl_20, rolling_win_rate,
       rolling_avg_quantity, rolling_trade_frequency, rolling_volatility, rolling_drawdown
FROM rolling""")(
    lambda spark, sf: features.add_rolling(
        (prepare_session(spark), fx.trades_from_lineitem(spark, sf))[1]).select(
        F.col("id").alias("trade_id"), "account", "permutation_id", *features.ROLLING_COLUMNS))

# ---------------------------------------------------------------------------
# F, G: macro stream, as-of join, feature store
# ---------------------------------------------------------------------------


def stream_sql() -> str:
    """macro_series -> stream (x, stream statistics, per-series last values)."""
    w = P.macro_window
    b = 1.0 - 2.0 / (P.ewma_span + 1.0)
    O = "ORDER BY pos"
    M = f"({O} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    U = f"({O} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""
xs AS (
  SELECT series_id, date, value, release_date,
         coalesce(value / NULLIF(lag(value) OVER (PARTITION BY series_id ORDER BY release_date NULLS LAST, date), 0)
                  - 1.0, 0.0) AS x
  FROM macro_series),
pos_s AS (SELECT *, row_number() OVER (ORDER BY release_date NULLS LAST, series_id, date) - 1 AS pos FROM xs),
st0 AS (
  SELECT *,
    avg(x) OVER {M} AS rolling_mean, stddev_samp(x) OVER {M} AS rolling_std,
    var_samp(x) OVER {M} AS rolling_var, min(x) OVER {M} AS rolling_min, max(x) OVER {M} AS rolling_max,
    quantile_cont(x, 0.5) OVER {M} AS rolling_median,
    skewness(x) OVER {M} AS rolling_skewness, kurtosis(x) OVER {M} AS rolling_kurtosis,
    list(x) OVER {M} AS arr12,
    list(x) OVER {U} AS arr_e,
    lag(x, 1) OVER ({O}) AS lag_1, lag(x, 2) OVER ({O}) AS lag_2, lag(x, 3) OVER ({O}) AS lag_3,
    lag(x, 6) OVER ({O}) AS lag_6, lag(x, 12) OVER ({O}) AS lag_12,
    lag(release_date, 1) OVER ({O}) AS prev_release,
    avg(x) OVER {U} AS expanding_mean, stddev_samp(x) OVER {U} AS expanding_std,
    last_value(CASE WHEN series_id = 'DGS10' THEN value END IGNORE NULLS) OVER {U} AS last_dgs10,
    last_value(CASE WHEN series_id = 'DGS2' THEN value END IGNORE NULLS) OVER {U} AS last_dgs2,
    last_value(CASE WHEN series_id = 'CPIAUCSL' THEN x END IGNORE NULLS) OVER {U} AS last_cpi
  FROM pos_s),
stream AS (
  SELECT *,
    x AS rolling_percent_change,
    CASE WHEN rolling_std > 0 THEN (x - rolling_mean) / rolling_std ELSE 0.0::DOUBLE END AS rolling_zscore,
    rolling_std AS macro_rolling_volatility, rolling_var AS macro_rolling_variance,
    (len(list_filter(arr12, lambda v: v < x)) + (len(list_filter(arr12, lambda v: v = x)) + 1) / 2.0)
      / len(arr12) AS macro_rolling_percentile,
    list_sum(list_transform(arr_e, lambda v, i: v * pow({b!r}, len(arr_e) - i)))
      / list_sum(list_transform(arr_e, lambda v, i: pow({b!r}, len(arr_e) - i))) AS macro_ewma,
    x - lag_1 AS macro_momentum, (x - lag_1) - (lag_1 - lag_2) AS macro_acceleration,
    CASE WHEN x IS NOT NULL AND expanding_mean IS NOT NULL THEN
      CASE WHEN x > expanding_mean THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END END AS macro_regime,
    (epoch_us(release_date) - epoch_us(prev_release)) / 86400000000.0 AS release_frequency,
    last_dgs10 - last_dgs2 AS yield_curve_spread, last_cpi AS inflation_momentum
  FROM st0)"""


_PICKS = ", ".join(features._STREAM_PICKS)


def releases_sql() -> str:
    return f"""
first_rows AS (
  SELECT release_date, {_PICKS} FROM stream
  WHERE release_date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY release_date ORDER BY pos) = 1),
last_rows AS (
  SELECT release_date, yield_curve_spread, inflation_momentum FROM stream
  WHERE release_date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY release_date ORDER BY pos DESC) = 1),
releases AS (
  SELECT f.*, l.yield_curve_spread, l.inflation_momentum,
         lead(f.release_date) OVER (ORDER BY f.release_date) AS next_release
  FROM first_rows f JOIN last_rows l USING (release_date))"""


MACRO_OUT = ", ".join(
    ["days_since_release", "days_until_next_release"]
    + [f"r.{c} AS {c}" for c in features._STREAM_PICKS + features._LAST_PICKS])


def asof_sql(src: str = "trades") -> str:
    return f"""
matched AS (
  SELECT t.*, r.release_date AS m_release, r.next_release AS m_next,
         {", ".join(f"r.{c} AS {c}" for c in features._STREAM_PICKS + features._LAST_PICKS)}
  FROM {src} t ASOF LEFT JOIN releases r ON t."timestamp" > r.release_date),
with_macro AS (
  SELECT *,
    (epoch_us("timestamp") - epoch_us(m_release)) / 86400000000.0 AS days_since_release,
    (epoch_us(CASE WHEN m_release IS NULL THEN (SELECT min(release_date) FROM releases) ELSE m_next END)
       - epoch_us("timestamp")) / 86400000000.0 AS days_until_next_release
  FROM matched)"""


FEATURE_SELECT = """
SELECT id AS trade_id, '{fv}' AS feature_version, '{pv}' AS pipeline_version,
       TIMESTAMP '{stamp}' AS feature_timestamp,
       {time_cols},
       rolling_pnl_5, rolling_pnl_20, rolling_win_rate, rolling_avg_quantity, rolling_trade_frequency,
       rolling_volatility, rolling_drawdown,
       days_since_release, days_until_next_release, {picks}, yield_curve_spread, inflation_momentum,
       holding_time, threshold,
       '{{"holding_time": ' || coalesce(CAST(holding_time AS VARCHAR), 'null') || ', "threshold": '
         || coalesce(CAST(threshold AS VARCHAR), 'null') || '}}' AS risk_parameters,
       permutation_id, pnl
FROM with_macro"""


def feature_store_ctes(trades_cte: str = fx.TRADES_EVENTS_SQL, macro_cte: str | None = None) -> list[str]:
    """CTEs ending in ``fs`` (the feature store)."""
    macro_cte = macro_cte or fx.macro_sql()
    body = FEATURE_SELECT.format(
        fv=P.feature_version, pv=P.pipeline_version, stamp=RUN_STAMP.isoformat(sep=" "),
        time_cols=time_sql(), picks=_PICKS)
    return [trades_cte, macro_cte, rolling_sql(), stream_sql(), releases_sql(), asof_sql("rolling"),
            f"fs AS ({body})"]


def feature_store_sql(trades_cte: str = fx.TRADES_EVENTS_SQL, macro_cte: str | None = None) -> str:
    return _with(*feature_store_ctes(trades_cte, macro_cte)) + "SELECT * FROM fs"


def _feature_store(spark, sf, **kw):
    return features.build_features(_trades(spark, sf), _macro(spark, sf), feature_timestamp=RUN_STAMP, **kw)


register("g7_feature_store", feature_store_sql())(
    lambda spark, sf: _feature_store(spark, sf))


@register("f_macro_stream", _with(fx.macro_sql(), stream_sql()) + """
SELECT series_id, date, release_date, x, rolling_mean, rolling_std, rolling_min, rolling_max, rolling_median,
       rolling_zscore, macro_rolling_variance, macro_rolling_percentile, macro_ewma, rolling_skewness,
       rolling_kurtosis, expanding_mean, expanding_std, macro_momentum, macro_acceleration, macro_regime,
       lag_1, lag_3, lag_6, lag_12, release_frequency, yield_curve_spread, inflation_momentum
FROM stream""")
def _f_stream(spark, sf):
    prepare_session(spark)
    s = features.macro_stream(fx.macro_from_orders(spark, sf, daily=True))
    return s.select("series_id", "date", "release_date", "x", "rolling_mean", "rolling_std", "rolling_min",
                    "rolling_max", "rolling_median", "rolling_zscore", "macro_rolling_variance",
                    "macro_rolling_percentile", "macro_ewma", "rolling_skewness", "rolling_kurtosis",
                    "expanding_mean", "expanding_std", "macro_momentum", "macro_acceleration",
                    "macro_regime", "lag_1", "lag_3", "lag_6", "lag_12", "release_frequency",
                    "yield_curve_spread", "inflation_momentum")


ORACLE["f_macro_stream"] = ORACLE["f_macro_stream"].replace(fx.macro_sql().strip(), fx.macro_sql(daily=True).strip())


@register("f9_asof_macro_lineitem", _with(fx.TRADES_LINEITEM_SQL, fx.macro_sql(shift_days=0), stream_sql(),
                                           releases_sql(), asof_sql("trades")) + f"""
SELECT id AS trade_id, {MACRO_OUT.replace('r.', '')} FROM with_macro""")
def _f9_li(spark, sf):
    prepare_session(spark)
    t = fx.trades_from_lineitem(spark, sf)
    rel = features.release_table(features.macro_stream(fx.macro_from_orders(spark, sf, shift_days=0)))
    return features.add_macro(t, rel).select(F.col("id").alias("trade_id"), *features.MACRO_COLUMNS)


@register("g5_leakage_audit", _with(fx.TRADES_EVENTS_SQL, fx.macro_sql(), stream_sql(), releases_sql(),
                                     asof_sql("trades")) + """
SELECT count_if(days_since_release < 0) AS violations, count(*) AS "rows" FROM with_macro""")
def _g5(spark, sf):
    prepare_session(spark)
    t = fx.trades_from_events(spark, sf)
    rel = features.release_table(features.macro_stream(_macro(spark, sf)))
    return features.audit_leakage(features.add_macro(t, rel))


from quantspark import catalog_eval  # noqa: E402,F401  (registers the evaluation queries)
from quantspark import catalog_model  # noqa: E402,F401  (registers the model queries)
from quantspark import catalog_diag  # noqa: E402,F401  (registers the diagnostics queries)
from quantspark import catalog_core  # noqa: E402,F401  (registers the core and store checks)
