"""Operators for preparing language-model training text, and their registered queries."""

import sys

from pyspark import cloudpickle

# The functions that tasks run travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
