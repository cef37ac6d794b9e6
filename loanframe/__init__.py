"""Loan-risk analytics as Spark DataFrame operations.

Everything takes and returns DataFrames or Columns; fitted steps are
``pyspark.ml`` estimators and models.
"""

import sys

from pyspark import cloudpickle

# tasks get the library's functions with their closures: workers need not have it on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
