"""Rating-table analytics, feature recipes, regressors, scoring and evaluation on Spark."""

import sys

from pyspark import cloudpickle

# Ship the few functions that run in Python workers by value, so that executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
