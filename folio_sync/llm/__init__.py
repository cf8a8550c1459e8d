"""Operators for preparing training text, each with its query in `catalog`."""

import sys

from pyspark import cloudpickle

# Tasks get this code with the functions they run; workers need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
