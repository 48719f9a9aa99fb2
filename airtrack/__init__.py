"""airtrack: drone-detection analytics written as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their closure, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
