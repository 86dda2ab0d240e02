"""Training-data operators: text in, Spark DataFrames out.

The functions that run inside tasks are sent to the workers by value, so that
an executor needs the installed libraries only and no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
