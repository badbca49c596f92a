"""Operators for preparing training text at scale.

Functions of this package that run inside Python workers are shipped with the job, so workers
need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
