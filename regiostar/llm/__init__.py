"""Operators that prepare text for training; nothing else in the package imports this folder."""

from pyspark import cloudpickle

import regiostar

# Functions travel to Python workers with their code, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(regiostar)
