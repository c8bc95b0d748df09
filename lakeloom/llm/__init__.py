"""Operators for training-data pipelines.

Nothing else in the library imports this package. Functions that run inside
tasks are shipped by value, so executors need the public libraries only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
