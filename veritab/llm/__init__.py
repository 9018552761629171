"""Operators of a training-data pipeline: scoring, filtering, deduplication,
decontamination, packing and token output.

Nothing outside this subpackage imports it.  Shared conventions:

* an operator takes a DataFrame and the names of its id and text columns,
  reads only those (other columns of any name are ignored) and returns its own
  result columns;
* null text counts as empty text; rows with a null id are kept, null being an
  id like any other;
* rows with equal id and equal text are one document and get equal results.
"""

import sys

from pyspark import cloudpickle

# functions of this subpackage travel inside the task, so that executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
