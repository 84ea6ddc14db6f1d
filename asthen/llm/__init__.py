"""Operators for training-data pipelines: filtering, deduplication, packing, sharding, extraction."""

import sys

from pyspark import cloudpickle

# Functions go to executors by value, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
