"""Operators for preparing training text, and the queries that apply them to the given tables.

What runs in tasks is sent by value, so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
