"""Operators for training-data pipelines. Nothing else in the library imports this package.

Python functions of these modules travel to the executors with their code.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
