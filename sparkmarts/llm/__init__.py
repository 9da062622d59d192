"""Operators for preparing language-model training data.

Nothing else in the library imports this package. Its functions run inside
executors' Python workers, so they are shipped by value: the cluster needs no
installed copy of this repository."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
