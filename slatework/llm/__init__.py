"""Training-data operators: packing, extraction, decontamination, scans, search, models.

One module per operator; ``queries`` registers them. Nothing outside this
package imports it except the guarded line in ``__spark_entry__``.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
