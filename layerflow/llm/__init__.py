"""Training-data operators: each module is one operator, ``registry`` lists the queries.

Functions of this package travel to the executors by value, so they need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
