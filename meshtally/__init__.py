"""meshtally: territorial results as Spark DataFrame jobs.

Every public function takes DataFrames and returns DataFrames; Catalyst plans
the work and nothing is collected except sizes that are bounded by design.
"""

import sys

from pyspark import cloudpickle

# Tasks get the package's Python functions with the job, so executors need no
# copy of it on their own path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
