"""Training-data operators: formatting, scoring, sharding, decontamination, tokens, near duplicates, secrets, quality."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
