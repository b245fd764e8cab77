"""Operators of a training-data pipeline, as Spark jobs. Nothing outside this folder imports it.

Functions that run in Python workers travel with their tasks by value, so workers need no copy of
this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
