"""Operators for large training-data pipelines, and the queries that apply them.

Task functions of this package are sent to executors by value, so executors need numpy, pandas,
pyarrow and the named tokenizer files, but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
