"""Operators of a training-data pipeline over `documents` and `pages`; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Tasks get these functions by value, so executors need not find the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
