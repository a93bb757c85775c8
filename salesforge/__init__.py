"""salesforge: a Spark-native engine for retail order-line analytics.

Every public operator takes and returns ``pyspark.sql.DataFrame`` objects so
they compose with ``df.transform(f)``; the heavy lifting is left to Catalyst
(pruning, pushdown, partial aggregation, window-group limits) and AQE.

Layout
------
``sources``    table readers, the order-line export built from the star schema,
               CSV ingest and the warehouse / report sinks
``functions``  column-expression helpers (money rounding, dates, labels, hashing)
``operators``  cleaning, SQL analytics layer, payload, quality report, statistics
``plans``      physical helpers: materialisation, size-checked broadcast,
               distributed ranking / prefix sums
``streaming``  incremental daily ingest with Structured Streaming
"""

__version__ = "0.1.0"
