"""cadenza: popularity analytics over nested collections, on Spark.

Operators are plain functions ``DataFrame -> DataFrame``; nothing reads a
path except ``cadenza.sources``.
"""

__version__ = "0.1.0"
