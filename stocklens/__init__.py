"""Stock appraisal on Spark: monthly sales and inventory in, a star of analytical facts out.

Every operator takes and returns DataFrames and carries DEAL_ID in its keys, so any number of deals is
one plan. Tables that many steps read are staged, which runs jobs while a plan is built.
"""

import sys

from pyspark import cloudpickle

# Functions that run on workers travel with the plan, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
