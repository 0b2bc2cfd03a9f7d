"""Operators of a training-data pipeline: cleaning, deduplication, mixing, formatting.

Nothing else in the library imports this package; it may be removed as a whole.
"""

import sys

from pyspark import cloudpickle

# Ship the functions themselves: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
