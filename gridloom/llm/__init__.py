"""Operators of a training-data pipeline: filtering, deduplication, decontamination, mixing, scoring and search of text.

Nothing else in the package imports this folder.
"""

import sys

from pyspark import cloudpickle

# Tasks get the code of this folder by value: executors need numpy, pandas and pyarrow, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
