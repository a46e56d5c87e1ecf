"""Timestamps of test rows from text."""

import datetime as dt


def ts(x: str):
    fmt = "%Y-%m-%d %H:%M:%S.%f" if "." in x else "%Y-%m-%d %H:%M:%S"
    return dt.datetime.strptime(x, fmt)
