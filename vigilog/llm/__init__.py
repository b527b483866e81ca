"""Operators for preparing training data, their queries and the SQL they are checked against.

Functions of this package travel to the executors with the plan, so a cluster needs no copy of
it: only the libraries that they import.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
