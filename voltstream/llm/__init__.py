"""Operators of a training-data pipeline: one module per operator, queries in ``registry``.

Functions that run in Python workers are pickled by value, so executors need
no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
