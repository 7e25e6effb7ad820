"""Batch analytics over match event data, written as Spark jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The functions that run in Python workers travel with their code, so the package need not be
# installed (or be on the path) where the executors run.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
