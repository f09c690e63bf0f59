"""Training-data operators.  Self-contained: nothing else in the library
imports this subpackage, and removing it leaves the rest working."""

import sys

from pyspark import cloudpickle

# Executors need not have this package: what a task calls travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
