"""Operators that prepare a text corpus for training a language model.

Functions of this package that run inside tasks travel with the task, so
executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
