"""Tablewright: instruction data preparation and text evaluation as Spark jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions travel to the executors by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
