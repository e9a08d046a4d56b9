"""Operators for preparing training data: one module per operator, queries in ``queries``."""

import sys

from pyspark import cloudpickle

# Python tasks get this package's functions with the task, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
