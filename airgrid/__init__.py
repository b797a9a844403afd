"""Block-by-block rating forecasts for broadcast grids, planned as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions for the executors travel with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
