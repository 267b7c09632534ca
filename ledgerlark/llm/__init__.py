"""Operators for preparing language-model training data; see the modules.

Functions of this package travel to the tasks by value, so executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
