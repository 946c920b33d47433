"""Operators of a training-data pipeline (toxicity, chat, dedup, scans, mixing, shards).

Nothing else in the library imports this subpackage.  Its Python functions are
pickled by value, so workers need no copy of the package on their own disks.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
