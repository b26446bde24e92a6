"""Operators of a training-data pipeline: one module per operator, ``queries`` and ``oracle`` for the registered ones."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the plan, so that no executor needs a copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
