"""Operators for large training corpora.

Each module is one operator with its own interface; :mod:`batchkit.llm.queries`
binds them to the driver's tables.  Nothing outside this package imports it.

Functions of this package that run in Python workers are pickled by value, so
executors need the libraries only, not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
