"""Settlement reconciliation analytics as Spark DataFrame jobs."""
