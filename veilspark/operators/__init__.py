"""veilspark.operators."""
