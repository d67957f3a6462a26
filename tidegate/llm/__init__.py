"""Operators for training-data pipelines.

Functions of this package that run inside Python workers are shipped by value,
so executors need numpy, pyarrow and tokenizers, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
