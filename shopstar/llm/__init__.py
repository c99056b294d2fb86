"""Training-data operators. Nothing else in the library imports this
subpackage; its queries are registered only when it is present.

Functions that run in Python workers are sent by value, so executors need the
installed libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
