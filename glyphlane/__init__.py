"""Spark jobs for the data work around vision-language models."""

import sys

from pyspark import cloudpickle

# Python tasks get the few helper functions by value: executors need not have
# this package installed or on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
