"""Training-data operators: packing, quality rules, sharding, secret scans, PII, licence scans,
benchmark decontamination, SimHash near-duplicates, HTML extraction, toxicity, conversation repair,
conversation prefix tries and nearest neighbours.

Nothing outside this package imports it.  Python functions that run in tasks are pickled by
value, so executors need no copy of the package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
