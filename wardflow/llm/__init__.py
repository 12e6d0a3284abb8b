"""Operators of a training-data pipeline.

Nothing else in the library imports this subpackage.  Its functions are sent to
executors by value, so the cluster needs no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
