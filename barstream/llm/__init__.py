"""Operators for building training data; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions go to the executors by value, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
