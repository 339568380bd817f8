"""Operators that prepare text for training language models.

Functions that run inside tasks travel with the job, so executors need this package neither
installed nor on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
