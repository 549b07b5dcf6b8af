"""Web-log anomaly analytics on Spark DataFrames and Structured Streaming."""

import sys

from pyspark import cloudpickle

# Python helpers travel to the executors with the task, so the package need not be
# installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
