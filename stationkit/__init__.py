"""stationkit: station-series preparation and regression on Spark.

Functions that Spark ships to Python workers (the per-batch moment sums,
the least-squares solves, dense scoring) are pickled by value, so the
workers need no installed copy of this package, on a cluster or when the
caller's working directory is elsewhere.
"""

from __future__ import annotations

import sys

try:  # PySpark's bundled cloudpickle
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the hook
    pass

__all__ = ["config", "session"]
