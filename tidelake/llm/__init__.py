"""Operators of a training-data pipeline; the rest of the library does not import them."""

from pyspark import cloudpickle

import tidelake

# Functions travel to the Python workers whole, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(tidelake)
