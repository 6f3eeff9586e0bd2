"""orderloom: e-commerce order analytics written as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the task, so the
# package needs no installation on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
