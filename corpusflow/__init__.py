"""Corpus preparation for language-model pre-training as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, so executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
