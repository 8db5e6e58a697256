"""Operators for training data: text, near-duplicates, packing, search, sharding.

Functions of this package travel to the workers whole, so they need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
