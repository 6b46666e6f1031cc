"""Security log analytics on Spark."""

import sys as _sys

try:  # functions of this package run inside Python workers (pandas folds):
    # ship them by value, so executors need not have the package installed
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: rely on --py-files
    pass
