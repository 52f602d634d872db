"""Batch and streaming text retrieval on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks are shipped by value, so that workers need no copy
# of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
