"""Operators that turn raw text and vectors into training data.

Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Code of this package goes to the Python workers with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
