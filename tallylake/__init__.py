"""Member-transaction analytics as Spark DataFrame jobs."""
