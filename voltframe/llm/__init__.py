"""Training-data operators: scoring, archives, span finding, mixing, duplicate
removal, encoding and fingerprints over web-scale document tables.

Nothing else in the library imports this subpackage.  Task-side functions are
shipped by value, so executors need no copy of the library on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
