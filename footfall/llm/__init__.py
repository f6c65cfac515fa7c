"""Operators for preparing training text: filters, near duplicates, mixing, tokens."""

import sys

from pyspark import cloudpickle

# Functions travel to the workers with their code: these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
