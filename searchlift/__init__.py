"""Search-opportunity analytics as Spark DataFrame jobs."""
