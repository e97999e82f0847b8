"""Card-transaction analytics as Spark DataFrame jobs, batch and streaming."""
