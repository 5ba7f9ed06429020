"""quarry: document chunking, embedding, vector indexing, retrieval and
evaluation as Spark DataFrame jobs."""

import sys as _sys

try:
    # Python functions shipped to executors (Arrow kernels, pandas UDFs) are
    # pickled by value, so workers need no import path for this package.
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover
    pass

__version__ = "0.1.0"
