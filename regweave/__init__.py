"""Company-registry enrichment as ordinary Spark DataFrame jobs."""
