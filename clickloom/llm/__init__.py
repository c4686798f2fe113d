"""Operators for preparing training data, and the queries that run them over the given tables."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to the tasks by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
