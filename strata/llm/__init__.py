"""Operators of a training-data pipeline (one module per operator).

Nothing outside this folder imports it.  ``queries.py`` registers one query per
operator; every operator has its own general interface in its module.

Functions of this package travel to Spark's Python workers by value, so the
executors need numpy and pyarrow but no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
