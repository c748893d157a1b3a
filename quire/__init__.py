"""Corpus preparation on Spark DataFrames: sentences, vocabularies, token
sequences, packed blocks, instruction examples, batches and run metrics."""

import sys

from pyspark import cloudpickle

# Small helpers travel inside the Python functions that use them, so executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
