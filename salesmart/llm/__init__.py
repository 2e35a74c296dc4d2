"""Operators of a training-data pipeline: cleaning, dedup, decontamination and mixing of documents."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors with the task, so the
# Python workers need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
