"""Clinical-encounter risk analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.2.0"

# Functions of this package travel to the Python workers by value, so that a worker
# need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
