"""Chat-corpus quality, preparation and scoring as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Task-side helpers travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
