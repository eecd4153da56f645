"""Candidate-gene evidence analytics on Spark."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with the job: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
