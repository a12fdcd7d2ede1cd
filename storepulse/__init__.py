"""storepulse — live and daily shop dashboards as Spark DataFrame jobs.

Layout:
  sources/    log, change-record and warehouse readers (batch and streaming)
  functions/  column expressions: date parts, masking, shares, tokenizer, JSON
  operators/  dedup, KPI aggregates, keyword search, ranking, paging
  sinks/      partitioned table writers (replay-safe), topic publishing, archive
  streaming/  Structured Streaming jobs: daily devices, orders, change records, log collection
  plans/      test-table adapters and the query catalogue used by ``__spark_entry__``
"""

__version__ = "0.1.0"
