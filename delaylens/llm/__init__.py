"""Operators for preparing text corpora: duplicates, decontamination, mixing, scoring, sharding.

Functions that run inside Spark's Python workers are shipped by value, so that executors need
no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
