"""Operators for training data: cleaning, deduplicating, scoring, tokenizing and packing text."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the query, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
