"""Everyday analytics as Spark DataFrame jobs.

Every public function takes DataFrames plus column names and returns a
DataFrame (or a small fitted object).  Nothing here creates a session.
"""

import sys

from pyspark import cloudpickle

# Send this package's functions to the executors by value, so that a cluster
# needs no copy of it installed on every machine.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
