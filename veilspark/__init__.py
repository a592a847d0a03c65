"""veilspark: protection of personal and payment-card columns on Spark.

Column tags from a JSON manifest, salted SHA-2 hashes next to sensitive
columns, read masks, an anonymized layer, wrapped salt keys with rotation,
and incremental protection with Structured Streaming; all as DataFrame
operators over catalog metadata and data tables.
"""

__version__ = "0.1.0"
