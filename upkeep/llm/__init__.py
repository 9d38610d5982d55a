"""Operators of a training-data pipeline: one module per operator, queries in ``queries.py``.

Functions of this package run inside Spark's Python workers. They are pickled by value, so a cluster needs no copy
of the package on its executors (only numpy, pyarrow and the tokenizer libraries).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
