"""Operators for large-scale training-data pipelines.

Ten operators over plain tables of documents or vectors. Nothing else in the
library imports this subpackage. Its functions are pickled by value, so that
executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
