"""Operators for training-data pipelines over the text, page and vector tables.

Each module holds one operator with its own general interface; ``catalog``
registers the thin ``opN_*`` queries over the given tables.  Nothing else in
the library imports this subpackage.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions that run inside tasks travel with the job, so workers need no copy of the package.
register_pickle_by_value(sys.modules[__name__])
