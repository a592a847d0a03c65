"""Operators of a training-data pipeline (deduplication, search, packing, filters).

Nothing else in the library imports this package. Functions that run in tasks travel
by value, so that executors need numpy, pyarrow and the libraries named, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
