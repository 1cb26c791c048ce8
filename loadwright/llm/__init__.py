"""Training-data operators; nothing else in the library imports this package."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Executors get the functions by value: the repository need not be on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
