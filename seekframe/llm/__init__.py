"""Operators of a training-data pipeline; nothing else in the library imports them.

Each module holds one operator with its own general interface; ``catalog``
registers one query per operator over the given tables, with its SQL where SQL
can express it.
"""

import sys

from pyspark import cloudpickle

# functions travel to the executors by value, so only the driver needs this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
