"""Training-data pipeline operators (one module each); see the README.

Functions of this package that run inside tasks are shipped by value, so
executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
