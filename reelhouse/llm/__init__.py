"""Operations for preparing training text. Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with them, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
