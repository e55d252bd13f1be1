"""Operators for large training-data corpora; nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
