"""newsvault: an incremental news-risk data vault expressed as Spark jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in tasks travel by value, so workers need no copy of this package, whatever
# folder the job was started from.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
