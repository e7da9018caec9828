"""Spark-native analytics for tandem-repeat loci, families and genome coverage."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors whole, so that those need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
