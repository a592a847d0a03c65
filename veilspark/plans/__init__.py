"""veilspark.plans."""
