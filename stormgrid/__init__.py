"""Location-based lead analytics as Spark DataFrame jobs."""
