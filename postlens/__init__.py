"""Social post analytics as Spark jobs: DataFrame in, DataFrame out."""

import sys

from pyspark import cloudpickle

# Functions that run on executors are sent with their code, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
