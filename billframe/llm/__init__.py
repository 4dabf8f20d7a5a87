"""Training-data operators: each module holds one operator; ``queries`` registers them.

Functions of this subpackage travel to the executors by value, so workers need
no copy of the repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
