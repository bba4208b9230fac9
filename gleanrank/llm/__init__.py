"""Operators for training-data pipelines, with their queries and SQL."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
