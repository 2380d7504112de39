"""Operators of a training-data pipeline: one module per operator, plus their queries.

Nothing outside this package imports it; the rest of the library works without it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to Python workers by value, so that executors need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
