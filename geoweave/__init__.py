"""geoweave: Spark-native analytics for a geographic knowledge graph."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions travel to Python workers with their code: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
