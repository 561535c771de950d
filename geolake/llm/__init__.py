"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage.  Task functions are
pickled by value, so executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
