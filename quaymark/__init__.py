"""A PySpark engine for market-data event logs."""

import sys

from pyspark import cloudpickle

# functions of this package travel to executors by value: these need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
