"""revlens — review analytics as Spark DataFrame operators.

Layout:
  functions/  Column-level expressions (buckets, flags, rounding, keys, parsing)
  sources/    readers, writers, seeds, sampling, test fixtures
  operators/  DataFrame operators (dedup, classification, rollups, reviewers,
              risk, calendar, SCD2 history, quality checks, profiling)
  plans/      the warehouse build (operator wiring) and the registered queries
"""

__version__ = "0.1.0"
