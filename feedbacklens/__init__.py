"""Analytics over free-text feedback, expressed as Spark DataFrame jobs."""
