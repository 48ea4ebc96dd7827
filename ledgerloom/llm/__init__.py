"""Operators for preparing training text; nothing else in the package depends on this folder."""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with their code, so workers need not find this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
