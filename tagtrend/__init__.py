"""Trend analytics over dated text records, expressed as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run inside Python tasks travel with the plan, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
