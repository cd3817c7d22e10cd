"""Cash-flow analytics over ledger tables, written as Spark DataFrame plans.

Every operator takes DataFrames and parameters and returns a DataFrame; nothing runs until the
caller asks for an action, except where a function says otherwise.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to Python workers by value, so workers need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
