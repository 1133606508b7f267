"""Operators for training-data corpora: quality, deduplication, decontamination, tokens, archives."""

import sys

from pyspark import cloudpickle

# functions travel to the workers with their code, so that executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
