"""Spark-native retrieval-augmented question answering and its evaluation, over whole tables."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
