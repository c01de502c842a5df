"""Operators that prepare text corpora for training; one module per operator."""

import sys

from pyspark import cloudpickle

# Tasks take these modules' functions along, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
