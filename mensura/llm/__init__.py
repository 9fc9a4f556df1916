"""Operators for preparing large text corpora, one module each.

Nothing outside this package imports it; ``queries`` lists what it registers.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that it need
# not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
