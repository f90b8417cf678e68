"""Operators of a pipeline for training data; nothing else imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, so a cluster
# needs no copy of it in every worker's path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
