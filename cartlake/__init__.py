"""cartlake: a basket-feature lakehouse on Spark DataFrames.

Packages
--------
sources    raw-layer inputs: typed CSV, JDBC, external Parquet tables, test fixtures
operators  DataFrame -> DataFrame work: features, row-level changes, quality checks
functions  Column expressions (flag parsing, guarded ratios, half-even rounding)
sinks      landing-zone writers and versioned table publishing
plans      the feature job and the registry of runnable queries
streaming  incremental change application (foreachBatch)
"""

__version__ = "0.1.0"
