"""Operators for preparing language-model training data.

Code that runs in tasks is sent along with them, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
