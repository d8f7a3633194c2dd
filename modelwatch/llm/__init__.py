"""Operators of a training-data pipeline: near-duplicates, tokenizers, classifiers, leaks, neighbours."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so that a job needs no installed copy there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
