"""Operators for preparing training text: joins of near copies, models, rules, records.

Functions that run in tasks travel with them, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
