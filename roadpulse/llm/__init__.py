"""Operators of a training-data pipeline.  Nothing outside this package imports it.

Python functions of this package travel to the executors by value, so a job
needs no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
