"""seriesflow: Spark-native preparation, feature building, forecasting and scoring
of time-ordered and tabular data across many series at once.

Every operator is a function ``DataFrame -> DataFrame`` built from native Spark
expressions, window functions, aggregations and Spark ML.
"""

import sys

from pyspark import cloudpickle

from seriesflow.session import checkpoint_dir, get_spark

# Functions that run in Python workers travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_spark", "checkpoint_dir"]
