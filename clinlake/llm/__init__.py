"""Training-data operators: deduplication, filtering, tokenization, search and scoring.

One module per operator; ``queries`` registers the thin contract queries.
Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
