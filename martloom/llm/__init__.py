"""Operators for preparing training text. The rest of the library does not use them.

Functions that run inside tasks are sent to the executors by value, so a cluster needs no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
