"""flowforge — Spark-native flow-classification analytics.

Every operator is a function ``DataFrame -> DataFrame`` built on Spark SQL,
Spark ML and Structured Streaming. Sub-packages:

* ``sources``   — readers / writers (CSV flows, parquet stages, model store)
* ``operators`` — cleaning, labels, profiling, features, split, resampling,
                  models, tuning, evaluation, explanation, scoring, alerts
* ``functions`` — reusable column expressions (hash order, safe division,
                  distributed global numbering)
* ``plans``     — fixture views over the driver tables and stage compositions
* ``streaming`` — streaming scoring into alerts
"""

from flowforge.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
