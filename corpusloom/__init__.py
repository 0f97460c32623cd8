"""corpusloom: text-corpus preparation expressed as Spark DataFrame jobs.

Sub-packages
------------
functions   column expressions (text, wikitext, verse/HTML, URLs)
sources     readers and writers with explicit schemas and row order
operators   distributed building blocks (first occurrence, dedup, selection,
            joins, tokenizer, mixture, packing)
plans       end-to-end jobs composed from the operators
streaming   restartable incremental ingest
catalog     registered queries and their SQL counterparts
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Ship the package's small Python helpers with the tasks that use them, so
# executors need no installed copy.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
