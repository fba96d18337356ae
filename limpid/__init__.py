"""limpid: a Spark-native engine for curating measurement tables and modelling on them."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to Python workers travel by value: executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
