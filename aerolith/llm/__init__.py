"""Operators for training-data corpora: documents, web pages, conversations and embeddings."""

import sys

from pyspark import cloudpickle

# Tasks get this package's functions with their jobs, so executors need no copy of it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
