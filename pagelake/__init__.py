"""Page and record analytics on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run in executors' Python workers are sent with the task, so
# executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
