"""Operators for training-data pipelines, and their registered queries."""

import sys

from pyspark import cloudpickle

# tasks get these modules' functions with the plan, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
