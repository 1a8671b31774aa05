"""Incremental file ingestion for a data lake, written as Spark jobs over tables of objects."""

import sys

from pyspark import cloudpickle

# Executors then need no installed copy of this package for the few Arrow helpers and data sources.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
