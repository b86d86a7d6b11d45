"""Moving-vehicle analytics over GPS waypoints, on Spark DataFrames and streams."""

import sys

from pyspark import cloudpickle

from wayfold.config import Settings

# Functions sent to Python workers carry their code with them, so the package
# need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Settings"]
