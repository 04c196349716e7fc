"""Operators of a training-data pipeline: one module per operator."""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with the job, so that executors
# need no copy of this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
