"""Operators for preparing training data, each in a module of its own.

Functions that run inside tasks are sent to the workers by value, so executors
need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
