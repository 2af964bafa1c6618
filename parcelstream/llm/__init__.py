"""Training-data operators: quality rules, near and substring dedup, personal
data, secrets, language, URL verdicts, source mixing, byte-level BPE and exact
nearest-vector search.  Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a cluster
# needs no copy of the library on its workers' import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
