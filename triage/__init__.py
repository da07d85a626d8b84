"""Message triage on Spark: select, normalize, classify, upsert and alert.

Layers: ``sources`` (message readers, MIME job, hand-off, keyed store),
``functions`` (column expressions), ``operators`` (DataFrame transforms),
``plans`` (whole runs and the registered queries), ``streaming``
(incremental ingest).
"""

__version__ = "0.1.0"

# Python workers (mapInPandas, foreachBatch helpers) need this package's
# functions; ship them by value so executors need no installed copy.
import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
