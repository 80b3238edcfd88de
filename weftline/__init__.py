"""weftline: Spark jobs that load, clean, enrich, dedupe, chunk, vectorise, search and publish text."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
