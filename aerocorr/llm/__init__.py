"""Operators for large text corpora (training-data preparation).

Nothing outside this package imports it.  Each module holds one operator; the
thin queries over the test tables are in :mod:`aerocorr.llm.queries`."""

import sys

from pyspark import cloudpickle

# The functions that run in Python workers travel with the job, so executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
