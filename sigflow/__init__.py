"""sigflow: Spark-native analytics for time-stamped sensor signals.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; I/O lives in :mod:`sigflow.sources` and
:mod:`sigflow.streaming`.
"""

__version__ = "0.1.0"
