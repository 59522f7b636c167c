"""Operators for preparing training data, each with a general interface of its own.

``queries`` binds them to the tables of the driver; nothing else in the library
imports this subpackage. Functions that run in tasks are shipped with the job, so
executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
