"""Operators that prepare training text: filtering, deduplication, scoring and packing.

Functions of this package travel to the executors by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
