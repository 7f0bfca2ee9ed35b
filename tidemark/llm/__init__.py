"""Operators for preparing training text at scale, one module for each.

Every operator takes DataFrames and returns DataFrames.  Functions that run in
Python workers are shipped by value, so the executors need this package's
dependencies (numpy, pyarrow, regex, xxhash) but not the package itself.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
