"""Training-data operators (mixing, language id, search, decontamination, dedup, scoring, scans, filters, formatting,
fill-in-middle, vector codes).

Functions that run inside Python tasks are pickled by value, so executors need no copy of this package.
"""

from pyspark import cloudpickle
import sys

cloudpickle.register_pickle_by_value(sys.modules[__name__])
