"""finpanel: company-by-period financial panels as Spark DataFrame operators.

Layout:
  functions/  pure Column expressions (null-safe division, clipping, flags, codes)
  sources/    readers and writers for filing tables, driver-table views
  operators/  filters, joins, aggregations, panel windows, reshaping, feature blocks,
              targets, profiling, imputation, pruning, correlation, k-NN
  ml/         splits, scaling, balancing, Spark ML fits, metrics, folds, search
  plans/      the three entries composed (consolidate, features, training set) and
              the registered query catalogue over the driver tables
  streaming/  incremental quarterly ingest with Structured Streaming
"""

__version__ = "0.1.0"
