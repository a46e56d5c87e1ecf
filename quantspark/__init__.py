"""quantspark: trade-log and macro time-series analytics as Spark DataFrame jobs.

Every public function takes DataFrames and returns DataFrames; the only
driver-side values are small, bounded ones (fold bounds, p x p matrices,
a handful of per-block states).
"""

from quantspark.config import Params
from quantspark.session import get_spark, prepare_session

__all__ = ["Params", "get_spark", "prepare_session"]
