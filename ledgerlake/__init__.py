"""ledgerlake: a layered analytics library for financial transactions on Spark.

Operators are lazy functions from DataFrame to DataFrame; only the sources,
the sinks and the plans that chain them touch storage.
"""
