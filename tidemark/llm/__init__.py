"""Operators for training-data pipelines. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions travel with their tasks, so executors need not have the repository on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
