"""Star-schema warehouse and retail analytics as Spark DataFrame jobs."""
