"""uttermill: speech-corpus preparation and transcript scoring as Spark jobs.

Every operator takes DataFrames and column names and gives back a lazy
DataFrame (or a ``Column``).  Nothing depends on row order, partitioning or
process-local state: keys are explicit and all randomness is a hash of them.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few functions that run in Python workers travel inside the plan, so
# executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
