"""Operators for preparing large text corpora, as Spark jobs over a documents table.

Nothing outside this folder imports it; the registered queries are in ``queries``.
"""

import sys

from pyspark import cloudpickle

# Functions of this package that run inside tasks travel whole, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
