"""cohortflow: recruitment-funnel analytics on Spark DataFrames, Spark SQL and Structured Streaming.

Layers:
  sources/    landing scans, driver-table fixtures, Bronze stamping, sinks
  operators/  reusable DataFrame operators (dedup, pivot, SCD2, upsert, marks, governance)
  functions/  column expressions (typed casts, safe ratios, rounding, calendar)
  plans/      compositions: Silver, Gold star, KPIs, measures, dashboard, lineage, quality
  streaming/  incremental file ingest and micro-batch Silver
"""

__version__ = "0.1.0"
