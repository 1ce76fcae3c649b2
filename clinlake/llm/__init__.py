"""Operators on training text, vectors, pages and conversations; nothing else in the library imports this package."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Tasks get their functions by value, so executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])
