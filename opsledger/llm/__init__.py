"""Operators of a training-data pipeline, each a Spark job over whole tables.

Nothing else in the library imports this subpackage; it may be deleted as a unit.
Functions that run in Python workers travel with their tasks, so executors need not have
the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
