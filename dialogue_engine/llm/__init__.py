"""Operators for preparing training text: scoring, finding copies, cleaning, packing."""

import sys

from pyspark import cloudpickle

# The Python functions of these modules travel to the executors whole, so that executors need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
