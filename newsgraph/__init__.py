"""newsgraph: map media coverage (newspapers, topics, persons) as Spark jobs.

Functions of this package that run inside Python workers (the model
client loop, the block-pair distance kernels, the Arrow UDFs) are pickled
by value, so executors need no copy of the package on their path."""

from __future__ import annotations

import sys as _sys


def _ship_by_value() -> None:
    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover
        return
    cloudpickle.register_pickle_by_value(_sys.modules[__name__])


_ship_by_value()
