"""Operators of a training-data pipeline over the documents and conversations tables."""

import sys

from pyspark import cloudpickle

# task code travels by value, so executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
