"""Operators for training-data pipelines: dedup, packing, mixing, classifiers, archives."""

import sys

from pyspark import cloudpickle

# Tasks get this subpackage's functions with the job, so that an executor needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
