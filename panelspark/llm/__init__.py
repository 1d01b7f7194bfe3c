"""Training-data operators. Nothing outside this package imports it.

The functions that run inside tasks are pickled by value, so executors need
numpy and pyarrow but not this package on their path.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
