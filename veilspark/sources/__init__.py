"""veilspark.sources."""
