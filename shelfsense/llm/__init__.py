"""Operators for preparing training data; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
