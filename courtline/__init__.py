"""courtline: daily-partitioned sports analytics as Spark DataFrame jobs.

Layers:
  sources/    raw tables, landed API responses, sheets, changed-file detection
  sinks/      day-partition replacement, table replacement, documents, load log
  functions/  column expressions (JSON parsing, guarded ratios, buckets, scores)
  operators/  DataFrame operators (latest row per key, global rank, calendar, joins)
  plans/      the models: staging -> marts -> reports -> summaries
  streaming/  incremental landing of new response files (Structured Streaming)
"""

__version__ = "0.1.0"
