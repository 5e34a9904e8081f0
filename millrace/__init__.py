"""Lakehouse data jobs as plain DataFrame-to-DataFrame functions for PySpark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the tasks by value, so workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
