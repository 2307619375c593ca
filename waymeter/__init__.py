"""waymeter: mobility KPIs from change-data-capture records, on PySpark."""

import sys

from pyspark import cloudpickle

# functions and processors go to the executors by value, so that a session of any origin can run them
cloudpickle.register_pickle_by_value(sys.modules[__name__])
