"""Python helpers that run in Spark's workers."""

from __future__ import annotations

import sys


def ship_by_value(module: str) -> None:
    """Pickle a module's functions by value: closures then carry their helpers to
    the Python workers, which need not have this package installed."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[module])
