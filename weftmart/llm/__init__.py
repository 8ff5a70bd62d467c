"""Operators of a training-data pipeline; nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# tasks get the functions of this folder by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
