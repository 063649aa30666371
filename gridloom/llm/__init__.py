"""Training-data operators: dedup, token counts, scans, fingerprints, packing, classifiers.

Nothing outside this folder imports it.  Task functions travel to the Python
workers by value, so executors need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
