"""Click-stream to article recommendations, as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions handed to Arrow tasks travel with their code, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
