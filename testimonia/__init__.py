"""Evidence analytics over hearing transcripts, expressed as DataFrame plans."""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: a cluster needs no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
