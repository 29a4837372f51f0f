"""Operators for preparing training corpora, each a composition of Spark jobs.

Nothing else in the library imports this subpackage. Functions that run
inside tasks are pickled by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
