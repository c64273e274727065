"""stayput — customer-retention analytics as Spark DataFrame operators.

Every operator takes and returns a ``pyspark.sql.DataFrame`` and is built from
native Spark expressions (no row-at-a-time Python UDFs), so Catalyst can push
filters and projections into the scan and whole-stage codegen can run the
column logic.

Layout:
  sources/    scans, sinks, fitted-state storage, the subscriber view
  functions/  column-expression helpers (binning, lookups, rounding, ...)
  operators/  cleaning, features, encoding, splits, scoring, metrics,
              decisions, portfolio summaries, training
  plans/      composite plans (FeaturePlan fit/transform, batch report,
              evaluation bundle)
  streaming/  Structured Streaming scoring
"""

__version__ = "0.1.0"
