"""Operators for preparing training text and vectors, and their registered queries.

Functions of this subpackage that run in Python workers are sent by value, so executors
need the third-party libraries but no copy of this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
