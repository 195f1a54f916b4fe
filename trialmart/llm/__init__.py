"""Operators for training-data pipelines; nothing outside this subpackage imports them.

Functions of this subpackage that run inside tasks travel with the tasks, so executors need no
copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
