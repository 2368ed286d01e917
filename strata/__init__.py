"""strata: medallion analytics on Spark.

Operators are functions from DataFrames to DataFrames built from native Spark
expressions. Entry points: ``strata.plans.monthly.run_month`` / ``backfill`` (the
stored pipeline), ``strata.plans.models.TripModels`` (the lazy model graph) and
``strata.streaming.pickup.ingest_available_now`` (incremental pick-up).
"""

__version__ = "0.1.0"
