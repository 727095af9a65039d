"""textlens: Spark-native curation, near-duplicate grouping, scoring and ingest
of short labelled texts and social posts."""

import sys as _sys

try:  # Python workers then need no installed copy of this package
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass
