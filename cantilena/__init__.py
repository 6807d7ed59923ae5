"""Timed-transcript analytics on Spark: typed tables, DataFrame operators, sources, sinks and streams."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that go to executors carry their code, so that executors need no copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
