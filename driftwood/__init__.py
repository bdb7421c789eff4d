"""driftwood: Spark-native data preparation, reconciliation, star-schema and
ML-feature operators on DataFrames.

Every operator takes and returns DataFrames built from native Spark
expressions; jobs in :mod:`driftwood.plans.jobs` compose them and trigger
actions only at sinks.
"""

__version__ = "0.1.0"
