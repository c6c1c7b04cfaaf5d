"""Analytics over large libraries of gray-scale images, as Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Kernels travel to the executors by value, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
