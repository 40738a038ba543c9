"""Landing XML to bronze tables, on Spark."""

import sys

from pyspark import cloudpickle

# Task functions travel with their job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
