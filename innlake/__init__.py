"""Hotel-operations lakehouse expressed as Spark DataFrame jobs."""
