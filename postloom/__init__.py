"""postloom: DataFrame-first curation and analysis of short social texts on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run on executors are sent whole, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
