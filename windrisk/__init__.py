"""Wind-shortfall risk on electricity zones, as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job that uses them, so the
# package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
