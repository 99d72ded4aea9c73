"""Operators for preparing training data, with their queries (``queries.py``).

Functions of this package that run inside tasks travel with the job by value, so executors
need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
