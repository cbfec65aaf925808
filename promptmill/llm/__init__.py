"""Operators for preparing training data for language models, and their registered queries."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel with the job, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
