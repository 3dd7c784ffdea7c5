"""Operators for large text corpora.  Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# task code travels with the task, so executors need no copy of this folder
cloudpickle.register_pickle_by_value(sys.modules[__name__])
