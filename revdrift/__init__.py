"""revdrift: revision-similarity analytics on Spark DataFrames."""

import sys as _sys

__version__ = "0.1.0"

# The few Arrow UDFs reference helpers of this package; ship them by value so
# Python workers (local or on a cluster) need not have the package installed.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark without the hook
    pass
