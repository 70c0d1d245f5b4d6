"""thermocline: keyed, time-stamped readings on Spark — batch tables and
Structured Streaming with one set of DataFrame functions."""

import sys

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value into Python UDFs, so
    executors run them without the package being installed there."""
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle
        pass


_ship_by_value()
