"""Operators for training-data pipelines; nothing else in the library imports them.

Functions of this package travel to the executors by value, so that only the driver needs
the package on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
