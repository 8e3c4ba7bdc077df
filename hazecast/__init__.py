"""Air-quality time-series analytics as Spark DataFrame functions."""

import sys

from pyspark import cloudpickle

# executors need not have the package installed: its functions travel with the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])
