"""Operators of a training-data pipeline, each over whole tables of documents, pages or vectors.

Functions of this package that run in Python workers travel with their tasks, so executors need
no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
