"""Training-data operators: packing, fingerprints, licence scans, line dedup,
decontamination, URL rules, token counts, SimHash, substring dedup, toxicity.

Nothing outside this subpackage imports it (``__spark_entry__`` adds its
queries only if it can be imported).
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so they need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
