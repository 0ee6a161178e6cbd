"""Telemetry analytics and model training as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
