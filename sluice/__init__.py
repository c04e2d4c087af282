"""sluice: batch and incremental order analytics as Spark DataFrame jobs.

Layers:
  sources/    raw CSV scans, record counts, landing folders, manifests
  operators/  reusable DataFrame -> DataFrame operators (tables, series, keyed
              aggregates, data quality, run log)
  functions/  column-level helpers (strict casts, time zones, text)
  plans/      the order-analytics models, load jobs and proof queries built
              from the operators
  streaming/  the incremental rate load as a Structured Streaming job
"""

__version__ = "0.1.0"
