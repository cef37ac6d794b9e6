"""Training-data operators: quality, de-duplication, packing, redaction, language, licences, mixing, web archives."""

import sys

from pyspark import cloudpickle

# tasks get this package's functions with their closures: workers need not have it on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
