"""Operators for text corpora. Task functions travel by value: executors need not have this package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
