"""papersieve: curate bibliographic records with Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to executors travel by value, so the package needs no
# installation there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
