"""Calendar and market-session expressions (all native, UTC session time)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quantspark.config import Params


def _c(ts) -> Column:
    return F.col(ts) if isinstance(ts, str) else ts


def hour_of_day(ts) -> Column:
    return F.hour(_c(ts))


def day_of_week(ts) -> Column:
    """Monday = 0 ... Sunday = 6 (``weekday``, not ``dayofweek``)."""
    return F.weekday(_c(ts))


def week_of_month(ts) -> Column:
    """ceil((day of month + weekday of the 1st) / 7); reaches 6 in long months."""
    t = _c(ts)
    first = F.trunc(F.to_date(t), "month")
    return F.ceil((F.dayofmonth(t) + F.weekday(first)) / F.lit(7.0)).cast("int")


def month(ts) -> Column:
    return F.month(_c(ts))


def quarter(ts) -> Column:
    return F.quarter(_c(ts))


def market_session(ts, params: Params = Params()) -> tuple[Column, Column, Column]:
    """(session, minutes_after_open, minutes_before_close).

    Minute of day = hour*60 + minute (seconds ignored); sessions are tried in
    the order us, europe, asia on [open, close); no match gives 'off_hours'
    with null minutes.
    """
    t = _c(ts)
    m = F.hour(t) * 60 + F.minute(t)
    name = after = before = None
    for sname, o, c in params.session_minutes():
        cond = (m >= o) & (m < c)
        if name is None:
            name = F.when(cond, F.lit(sname))
            after = F.when(cond, (m - o).cast("double"))
            before = F.when(cond, (F.lit(c) - m).cast("double"))
        else:
            name = name.when(cond, F.lit(sname))
            after = after.when(cond, (m - o).cast("double"))
            before = before.when(cond, (F.lit(c) - m).cast("double"))
    return name.otherwise(F.lit("off_hours")), after, before


def time_feature_columns(ts, params: Params = Params()) -> dict[str, Column]:
    session, after, before = market_session(ts, params)
    return {
        "hour_of_day": hour_of_day(ts),
        "day_of_week": day_of_week(ts),
        "week_of_month": week_of_month(ts),
        "month": month(ts),
        "quarter": quarter(ts),
        "market_session": session,
        "minutes_after_open": after,
        "minutes_before_close": before,
    }
