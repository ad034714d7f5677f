"""Operators of a training-data pipeline over documents, embeddings and pages.

Nothing else in the library imports this subpackage. Functions that run in
Python workers are shipped by value, so workers need no installed package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
