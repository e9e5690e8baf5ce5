"""Operators for the preparation of training text. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Task functions travel to the workers whole, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
