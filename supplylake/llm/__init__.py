"""Operators for large training-data pipelines.

Functions of this package that run inside Python workers are shipped by value,
so executors need no copy of the package on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
