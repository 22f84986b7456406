"""Training-data operators: near-duplicate joins, fingerprints, archives,
quality rules and classifiers, mixing, sharding, tokenising, secret and
license scans.  Nothing outside this folder imports it except the driver
entry, which leaves it out when the folder is missing."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel whole, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
