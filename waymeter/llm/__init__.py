"""Operators of a training-data pipeline: tokens, privacy, filters, archives and near duplicates.

Nothing else in the library imports this package. Functions that run inside Arrow
operators are sent to the executors by value, so a session of any origin can run them.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
