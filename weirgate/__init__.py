"""Spark-native model-lifecycle analytics: validate, prepare, train, select, gate, monitor."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the job, so executors do not
# need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
