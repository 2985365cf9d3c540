"""Training-data operators. Nothing else in the library imports this subpackage."""

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["*"]))
