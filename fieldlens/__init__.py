"""Sports-video trajectory, crowd and media-ledger analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Step functions travel to Python workers by value: executors do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
