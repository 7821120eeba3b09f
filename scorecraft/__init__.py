"""scorecraft: Spark-native table profiling, feature preparation, variable
selection and scorecard evaluation.

Every operator is a function ``DataFrame (+ params) -> DataFrame`` that keeps
its work on the cluster. Subpackages:

- ``sources``    readers, writers and round trips (CSV, Parquet, tables, views)
- ``functions``  column expressions (typed missing tests, buckets, tokens)
- ``operators``  ordering, profiling, sampling, features, selection, models,
                 clustering, text, evaluation, run log
- ``plans``      derived views over the test tables and the registered queries
"""

__version__ = "0.1.0"
