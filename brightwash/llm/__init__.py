"""Operators for training-data pipelines over document, page and vector tables.

Nothing else in the package imports this subpackage; it can be removed whole.
The functions that run inside tasks travel with the tasks, so the package need
not be installed on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
