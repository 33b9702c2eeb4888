"""Two-grain traffic screening as Spark DataFrame operators and ML estimators."""

import sys

from pyspark import cloudpickle

# Task functions travel to the executors by value, so a job also runs where the package was not
# shipped with --py-files.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
