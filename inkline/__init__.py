"""inkline - stylometric text analytics and classifier evaluation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Arrow functions travel to executors by value, so workers need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
