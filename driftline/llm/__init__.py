"""Operators that prepare training text: dedup, extraction, filtering, mixing and sharding."""

import sys

from pyspark import cloudpickle

# Functions sent to tasks carry their own code, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
