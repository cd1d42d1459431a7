"""Strength-sport results analytics on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value, so executors do not need this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
