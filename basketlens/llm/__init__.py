"""Operations on text corpora: deduplication, archives, sharding, classifiers, extraction, packing."""

import sys

from pyspark import cloudpickle

# The functions that run inside tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
