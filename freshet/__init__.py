"""freshet: streamflow time series and indices as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Python workers receive the few per-reach kernels by value, so executors need
# nothing installed besides PySpark, pandas and numpy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
