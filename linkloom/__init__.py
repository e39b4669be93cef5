"""linkloom: building web-text corpora with Spark DataFrames.

Every operator takes DataFrames and returns DataFrames.  Nothing is collected to the
driver except tables whose size was checked first (deny policies, vocabularies).
"""

import sys

from pyspark import cloudpickle

# Arrow UDF bodies travel to the executors inside the plan, so workers need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
