"""Operators for preparing language-model training data. Nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Python workers get these functions with their tasks; they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
