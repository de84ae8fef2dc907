"""Operators for preparing text corpora at scale; nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# tasks carry the functions they run, so executors need no copy of this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
