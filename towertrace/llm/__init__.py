"""Operators of a training-data pipeline: extraction, filters, duplicate
detection, decontamination, tokenisation and learned scores.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, so the executors
# need not have the repository on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
