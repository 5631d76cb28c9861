"""Operators for preparing training data.

Functions of this package travel to the tasks by value, so executors need not have it
installed.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
