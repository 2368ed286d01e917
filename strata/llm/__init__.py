"""Operators for building training corpora, and the queries that apply them.

Functions of this package travel to Python workers by value, so executors need the package's
requirements but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
