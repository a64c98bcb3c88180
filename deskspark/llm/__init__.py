"""Operators for preparing training text. Nothing else in the library imports this package.

Functions that run in Python workers are sent by value, so that executors need no copy of the
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
