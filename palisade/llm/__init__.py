"""Operators for text corpora.

Functions of this package travel to executors by value, so a cluster needs no copy
of it on the workers' path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
