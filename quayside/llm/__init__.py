"""Operators of a training-data pipeline; nothing else in the library imports them.

Functions that run in tasks travel to the executors by value, so that these
need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
