"""Training-data operators: dedup, decontamination, licences, quality, language,
archives, sharding and tokenizers. Nothing else in the library imports this
subpackage; ``queries.py`` holds its registered queries.

Functions that run inside tasks are pickled by value, so executors need no copy
of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
