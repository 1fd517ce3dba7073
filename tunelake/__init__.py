"""Spark-native preparation of instruction-tuning data and evaluation tables."""

import sys

from pyspark import cloudpickle

# Functions of this package go to Python workers by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
