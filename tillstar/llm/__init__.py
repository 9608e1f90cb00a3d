"""Operators of a training-data pipeline: scoring, filtering, deduplication, packing and mixing.

Functions of this subpackage that run inside tasks travel with the tasks, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
