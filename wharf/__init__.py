"""wharf: warehouse loading, checks and reports as plain Spark DataFrame functions.

Layout:
    functions/   Column-level helpers (cleaning, money, hashes, flags).
    sources/     Readers and writers: repaired event text, nested documents,
                 CSV by header name, versioned and date-partitioned tables.
    operators/   Joins, aggregates, windows, pivot, incremental loads, checks.
    plans/       Compositions over the driver's tables: the payment model
                 and the reports/KPIs registered in ``__spark_entry__``.
    streaming/   Incremental file ingestion with Structured Streaming.

Every function takes and returns DataFrames; run dates are parameters,
never the wall clock, so results repeat.
"""

from wharf.session import get_spark, work_dir

__all__ = ["get_spark", "work_dir"]
