"""Operators for preparing training text: tokens, quality, duplicates, leaks, licences, links.

One module per operator, ``queries.py`` for the registered queries and their SQL. Nothing else in
the library imports this subpackage. Functions of these modules travel to the executors inside the
job (pickled by value), so a cluster needs no copy of the package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
