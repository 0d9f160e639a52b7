"""Operations of a training-data pipeline: ten corpus operators and their registered queries."""

import sys

from pyspark import cloudpickle

# Executors get the functions of this package with the task and need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
